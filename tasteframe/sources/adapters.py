"""Rating, catalogue, tag and behaviour tables derived from the shared star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasteframe import constants as C


class Tables:
    """Lazy views over one folder of Parquet tables."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")

    def ratings(self) -> DataFrame:
        """userId, movieId, rating, timestamp: one row per (customer, part) bought."""
        li = self.read("lineitem").select("l_orderkey", "l_partkey", "l_quantity")
        o = self.read("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        day = F.datediff(F.max("o_orderdate").cast("date"), F.lit("1970-01-01").cast("date"))
        return (
            li.join(o, li.l_orderkey == o.o_orderkey)
            .groupBy(F.col("o_custkey").alias(C.USER), F.col("l_partkey").alias(C.ITEM))
            .agg(
                (F.ceil(F.avg("l_quantity") / 5.0) * 0.5).cast("double").alias(C.RATING),
                (day.cast("long") * 86400).alias(C.TIMESTAMP),
            )
        )

    @staticmethod
    def is_test() -> "F.Column":
        return (F.col(C.USER) * 31 + F.col(C.ITEM) * 17) % 100 < 20

    def train(self) -> DataFrame:
        return self.ratings().where(~self.is_test())

    def test(self) -> DataFrame:
        return self.ratings().where(self.is_test())

    def items(self) -> DataFrame:
        p = self.read("part").select("p_partkey", "p_name", "p_type", "p_size")
        return p.select(
            F.col("p_partkey").alias(C.ITEM),
            F.when(F.col("p_partkey") % 17 == 0, F.col("p_name"))
            .otherwise(F.concat("p_name", F.lit(" ("), (F.lit(1950) + F.col("p_size")).cast("string"), F.lit(")")))
            .alias(C.TITLE),
            F.when(F.col("p_partkey") % 23 == 0, F.lit(C.NO_GENRES))
            .otherwise(F.concat("p_type", F.lit("|"), F.replace("p_name", F.lit(" "), F.lit("|"))))
            .alias(C.GENRES),
        )

    def tags(self, items: int = 200) -> DataFrame:
        """Two-word tags spread over the given number of items; one row in 19 has none."""
        number = F.regexp_extract("props", "([0-9]+)", 1).cast("int") % 10
        return self.read("events").select(
            F.col("user_id").alias(C.USER),
            (F.col("event_id") % items).alias(C.ITEM),
            F.when(F.col("event_id") % 19 != 0, F.concat("event_type", F.lit(" "), number.cast("string"))).alias("tag"),
        )

    def behaviour(self) -> DataFrame:
        """Signals per (user, item)."""
        recent = F.lit("2024-01-24").cast("date")
        kind = lambda name: F.when(F.col("event_type") == name, 1).otherwise(0)
        return (
            self.read("events")
            .groupBy(F.col("user_id").alias(C.USER), (F.col("event_id") % 20).alias(C.ITEM))
            .agg(
                F.sum(kind("view")).cast("int").alias("n_watched"),
                F.max(kind("click")).alias("wishlist"),
                F.max(F.when(F.col("ts").cast("date") >= recent, 1).otherwise(0)).alias("recent"),
                F.max(kind("purchase")).alias("top10"),
            )
        )

    def library(self) -> DataFrame:
        """One person's library: signals per item over all events of items 0..199."""
        kind = lambda name: F.when(F.col("event_type") == name, 1)
        signals = (
            self.read("events")
            .groupBy((F.col("event_id") % 200).alias(C.ITEM))
            .agg(
                (F.count(kind("view")) % 7).alias("n_watched"),
                (F.count(kind("click")) % 2).alias("wishlist"),
                (F.count(kind("error")) % 2).alias("recent"),
                F.nullif(F.count(kind("purchase")) % 2, F.lit(0)).alias("top10"),
            )
        )
        return self.items().join(signals, C.ITEM)

    def genome_scores(self) -> DataFrame:
        return self.read("embeddings").select(
            F.col("vec_id").alias(C.ITEM), F.posexplode("embedding").alias("tagId", "x")
        ).select(C.ITEM, F.col("tagId").cast("long"), ((F.col("x").cast("double") + 1) / 2).alias("relevance"))

    def genome_tags(self) -> DataFrame:
        """Tag names of the 64 vector positions that occur."""
        return self.genome_scores().select("tagId").distinct().select(
            "tagId", F.concat(F.lit("tag "), F.col("tagId").cast("string")).alias("tag")
        )

    def tag_themes(self) -> DataFrame:
        return self.genome_tags().select("tagId", (F.col("tagId") % 8).cast("int").alias("theme_id"))

    def tag_vectors(self) -> DataFrame:
        return self.read("embeddings").select(F.col("vec_id").alias("tagId"), "embedding")

    def visuals(self) -> DataFrame:
        std = lambda c: F.coalesce(F.stddev_samp(c), F.lit(0.0))
        return self.read("lineitem").groupBy(F.col("l_partkey").alias(C.ITEM)).agg(
            F.avg("l_quantity").alias("f1"),
            std("l_quantity").alias("f2"),
            (F.avg("l_extendedprice") / 1000).alias("f3"),
            F.avg("l_discount").alias("f4"),
            std("l_discount").alias("f5"),
            F.avg("l_tax").alias("f6"),
            std("l_tax").alias("f7"),
        )

    def payloads(self) -> DataFrame:
        """Raw metadata answers: JSON text, null for every 13th item."""
        d = self.read("documents").select("doc_id", "text", "n_chars")
        payload = F.to_json(F.struct(
            F.concat(F.lit("Title "), F.col("doc_id").cast("string")).alias("title"),
            F.when(F.col("doc_id") % 11 != 0, F.col("text")).alias("overview"),
            F.concat((F.lit(1950) + F.col("doc_id") % 70).cast("string"), F.lit("-06-01")).alias("release_date"),
            (F.col("n_chars") % 180).cast("double").alias("runtime"),
            ((F.col("doc_id") % 100) / 10).alias("vote_average"),
            F.col("n_chars").alias("vote_count"),
            (F.col("n_chars") / 100).alias("popularity"),
            F.when(F.col("doc_id") % 7 != 0, F.concat(F.lit("/"), F.col("doc_id").cast("string"), F.lit(".jpg"))).alias("poster_path"),
        ))
        return d.select(
            F.col("doc_id").alias(C.ITEM),
            (F.col("doc_id") + 100000).cast("double").alias("tmdbId"),
            F.when(F.col("doc_id") % 13 != 0, payload).alias("payload"),
        )

    def item_vectors(self) -> DataFrame:
        """Text embeddings of items."""
        return self.read("embeddings").select(
            F.col("vec_id").alias(C.ITEM), F.col("embedding").cast("array<double>").alias("embedding")
        )

    def registered_users(self) -> DataFrame:
        """All customers, with their rating maps."""
        c = self.read("customer")
        r = self.ratings().groupBy(C.USER).agg(
            F.map_from_entries(F.collect_list(F.struct(F.col(C.ITEM).cast("string"), F.col(C.RATING)))).alias("ratings")
        )
        return c.join(r, c.c_custkey == r[C.USER], "left").select(
            F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"), "ratings"
        )

    def participants(self, user_ids: tuple[int, ...]) -> DataFrame:
        """A group: its members with the items they bought (liked) and clicked (wishlist)."""
        e = self.read("events").where(F.col("user_id").isin(list(user_ids)))
        item = (F.col("event_id") % 200).alias("id")
        marked = e.select("user_id", "event_type", item).distinct().join(
            self.items().select(F.col(C.ITEM).alias("id"), C.TITLE), "id"
        )
        pick = lambda kind: F.array_sort(F.collect_list(
            F.when(F.col("event_type") == kind, F.struct("id", C.TITLE))))
        return marked.groupBy("user_id").agg(
            pick("purchase").alias("liked"), pick("click").alias("wishlist")
        ).select(F.concat(F.lit("Person "), F.col("user_id").cast("string")).alias("name"), "user_id", "liked", "wishlist")

    def metadata(self) -> DataFrame:
        from tasteframe.operators.catalogue import json_extract_metadata
        from tasteframe.sources.tables import clean_metadata

        cols = [C.ITEM, C.TITLE, "overview", "release_date", "runtime", "vote_average", "vote_count",
                "popularity", "poster_path", "poster_url"]
        return clean_metadata(json_extract_metadata(self.payloads()).select(*cols))
