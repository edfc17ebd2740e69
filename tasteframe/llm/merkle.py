"""Merkle manifest of a data set: a content-addressed store of digest-to-children records, and proofs by descent from the root."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tasteframe.scratch import materialise

#: Children of a node, and the levels that a rank of 63 bits can have.
FAN, MOST_LEVELS = 8, 21
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PATH = "array<struct<before:array<string>,after:array<string>>>"


def digest_of(*parts: Column) -> Column:
    """H: lower-case hex SHA-256 of the parts, joined."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf_digest(**changed: Column) -> Column:
    """H of the fields of a row: each ``-`` if null, else its length in UTF-8 bytes, a colon and the value."""
    values = [changed.get(c, F.col(c)).cast("string") for c in FIELDS]
    return digest_of(*[F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values])


def height(n: Column) -> Column:
    """Levels above the leaves of a tree of ``n`` leaves; none above a lone leaf."""
    return sum((F.when(n > F.lit(FAN**i), 1).otherwise(0) for i in range(MOST_LEVELS)), F.lit(0))


def numbered(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """``df`` with ``number`` (from 0, in the order, within its group) and ``n`` (rows of the group). Eager.

    Rows are dealt into sampled ranges of group and order, and written in order; only the row counts of (range, group) are
    added up. Equal rows are dealt apart, in any order.
    """
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2)
    keys = [*group, *order, "_tie"]
    dealt = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    dealt = materialise(dealt.drop("_tie").withColumn("_at", F.monotonically_increasing_id()), "numbered")
    dealt = dealt.withColumn("_part", F.shiftright("_at", 33))
    sizes = dealt.groupBy("_part", *group).agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    all_of = W.partitionBy(*group)
    before = F.sum("_rows").over(all_of.orderBy("_part")) - F.col("_rows")
    sizes = sizes.select(F.col("_part").alias("_p"), *[F.col(c).alias(f"_g_{c}") for c in group], (before - F.col("_first")).alias("_shift"), F.sum("_rows").over(all_of).alias("n"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in group], F.col("_part") == F.col("_p"))
    return dealt.join(sizes, same).select(*df.columns, (F.col("_at") + F.col("_shift")).alias("number"), "n")


def levels_above(leaves: DataFrame) -> list[DataFrame]:
    """Nodes (tree, number, n, digest, children) level by level above ``leaves`` (tree, number, n, digest); n counts a tree's nodes of
    the level. Every ``FAN`` consecutive nodes become one, until a tree has a single node. Eager: one job per level."""
    out = []
    level = leaves
    top = leaves.agg(F.max(height(F.col("n")))).first()[0] or 0
    for _ in range(top):
        child = F.struct((F.col("number") % FAN).alias("digit"), "digest")
        up = level.filter("n > 1").groupBy("tree", F.floor(F.col("number") / FAN).alias("number"), F.ceil(F.col("n") / FAN).alias("n"))
        up = up.agg(F.array_sort(F.collect_list(child))["digest"].alias("children"))
        level = materialise(up.select("tree", "number", "n", digest_of(F.array_join("children", "")).alias("digest"), "children"), "nodes")
        out.append(level)
    return out


@dataclass
class Manifest:
    """``leaves`` (tree, number, n, digest and the given columns), ``langs`` (lang, tree, n, subroot), and the records of the store,
    level by level: ``records`` above the leaves, ``upper`` above the subroots. ``root`` is None for an empty table."""

    leaves: DataFrame
    langs: DataFrame
    records: list[DataFrame]
    upper: list[DataFrame]
    root: str | None

    def store(self) -> DataFrame:
        """(digest, children): the whole store, each content once."""
        none = self.leaves.limit(0).select("digest", F.array("digest").alias("children"))
        return reduce(DataFrame.union, [x.select("digest", "children") for x in [*self.records, *self.upper]], none).dropDuplicates(["digest"])


def build(rows: DataFrame) -> Manifest:
    """The manifest of ``rows`` (doc_id, lang, digest, and any others to carry along): a tree per lang, and one over their subroots.

    Leaves ascend by doc_id, null first; rows that share a doc_id ascend by digest. Langs ascend bytewise, null first. Eager.
    """
    leaves = numbered(rows, ["lang"], ["doc_id", "digest"])
    langs = numbered(leaves.groupBy("lang").agg(F.first("n").alias("size")), [], ["lang"])
    langs = materialise(langs.select("lang", F.col("number").alias("tree"), F.col("n").alias("trees"), "size"), "langs")
    names = langs.select(F.col("lang").alias("_lang"), "tree")
    leaves = materialise(leaves.join(names, F.col("lang").eqNullSafe(F.col("_lang"))).drop("_lang"), "leaves")
    bare = leaves.select("tree", "number", "n", "digest")
    records = levels_above(bare)
    tops = reduce(DataFrame.union, [x.select(bare.columns) for x in records], bare).filter("n = 1").select("tree", F.col("digest").alias("subroot"))
    langs = materialise(langs.join(tops, "tree").select("lang", "tree", "trees", F.col("size").alias("n"), "subroot"), "langs")
    subroots = langs.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("number"), F.col("trees").alias("n"), F.col("subroot").alias("digest"))
    upper = levels_above(subroots)
    top = (upper[-1] if upper else subroots).first()
    return Manifest(leaves, langs, records, upper, top and top["digest"])


def _down(frontier: DataFrame, records: DataFrame, wanted: DataFrame | None) -> DataFrame:
    """One level down: each node's record is looked up by digest, each child becomes a row, its siblings the next path segment."""
    found = frontier.join(records.select("digest", "children").dropDuplicates(["digest"]), "digest")
    others = [c for c in frontier.columns if c not in ("digest", "number", "path")]
    rows = found.select(*others, "number", "path", "children", F.posexplode("children").alias("digit", "digest"))
    rows = rows.select(*others, (F.col("number") * FAN + F.col("digit")).alias("number"), "digest", F.concat("path", F.array(_segment(F.col("digit")))).alias("path"))
    return rows if wanted is None else rows.join(wanted, [c for c in ("tree", "number") if c in wanted.columns], "semi")


def _segment(digit: Column) -> Column:
    """The children that a descent by ``digit`` does not select, before and after it."""
    return F.struct(F.slice("children", F.lit(1), digit).alias("before"), F.slice("children", digit + 2, F.lit(FAN)).alias("after"))


def proofs(m: Manifest, wanted: DataFrame | None = None) -> DataFrame:
    """The leaves' given columns, ``subroot`` and ``path``: for each level from the leaf up to the root, the siblings ``before`` and ``after``.

    All requests descend together from the root: a node that several requests pass is one row, and a child is followed if its
    position is the next rank digit (to base ``FAN``, of the lang's number and then of the leaf's) of a request. The children not
    selected are a path segment; segments run from the root down and are reversed at the end. ``wanted`` (doc_id) restricts
    the requests; by default every leaf is one.
    """
    spark = m.leaves.sparkSession
    leaves = m.leaves if wanted is None else m.leaves.join(wanted.select("doc_id").distinct(), "doc_id", "semi")
    trees = None if wanted is None else leaves.select(F.col("tree").alias("number")).distinct()
    start = F.array().cast(PATH).alias("path")
    frontier = spark.range(1).select(F.lit(m.root).alias("digest"), F.lit(0).cast("long").alias("number"), start)
    for k, records in reversed(list(enumerate(m.upper))):
        digits = trees and trees.select(F.floor(F.col("number") / FAN**k).alias("number")).distinct()
        frontier = _down(frontier, records, digits)
    arrived = frontier.join(m.langs.select(F.col("tree").alias("number"), "n"), "number")
    arrived = arrived.select(F.col("number").alias("tree"), F.lit(0).cast("long").alias("number"), "digest", F.col("digest").alias("subroot"), height(F.col("n")).alias("height"), "path")
    carried = [c for c in leaves.columns if c not in ("tree", "number", "n")]
    lone = arrived.filter("height = 0").select("tree", "subroot", "path").join(leaves, "tree").select(*carried, "subroot", "path")
    if not m.records:
        return lone.withColumn("path", F.reverse("path"))
    frontier = arrived.filter(F.col("height") == len(m.records)).drop("height")
    for k in range(len(m.records) - 1, 0, -1):
        digits = None if wanted is None else leaves.select("tree", F.floor(F.col("number") / FAN**k).alias("number")).distinct()
        frontier = _down(frontier, m.records[k], digits).unionByName(arrived.filter(F.col("height") == k).drop("height"))
    request = F.struct((F.col("number") % FAN).cast("int").alias("digit"), *carried)
    together = leaves.groupBy("tree", F.floor(F.col("number") / FAN).alias("number")).agg(F.collect_list(request).alias("requests"))
    last = m.records[0].select("digest", "children").dropDuplicates(["digest"])
    rows = frontier.join(together, ["tree", "number"]).join(last, "digest").select("subroot", "path", "children", F.explode("requests").alias("r"))
    rows = rows.select(*[F.col(f"r.{c}").alias(c) for c in carried], "subroot", F.concat("path", F.array(_segment(F.col("r.digit")))).alias("path"))
    return rows.union(lone).withColumn("path", F.reverse("path"))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf digest and its path, from the leaf up, lead to."""
    return F.aggregate(path, leaf, lambda acc, s: digest_of(F.array_join(s["before"], ""), acc, F.array_join(s["after"], "")))


def verify(documents: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified): a proof per row of ``documents``, checked after tampering. Eager.

    Where 3 divides the unsigned CRC-32 of doc_id in decimal, the given text has its A-Z lower-cased; its leaf is folded with the original
    siblings, and ``verified`` says whether the root comes out: false exactly where such a text has one of A-Z. Rows without doc_id
    are not tampered with; null texts and texts without capitals stay, so they verify. Repeated rows are leaves of their own. A table of one row
    has its leaf as subroot and root and the digest of nothing as proof; an empty table gives no rows. Other columns are ignored.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), *FIELDS[1:])
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    given = F.when(tampered, leaf_digest(text=F.translate("text", UPPER, LOWER)))
    m = build(materialise(docs.select("doc_id", "lang", leaf_digest().alias("digest"), given.alias("given")), "digests"))
    siblings = F.flatten(F.transform("path", lambda s: F.concat(s["before"], s["after"])))
    rows = proofs(m).select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", F.lit(m.root).cast("string").alias("root"), digest_of(F.array_join(siblings, "")).alias("proof_sha256"),
        folded(F.coalesce("given", "digest"), F.col("path")).alias("folded_root"),
    )
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


#: Grown upwards from the leaves, node by node, and proofs collected on the way: no descent.
ORACLE = """
WITH RECURSIVE crc AS (
    SELECT list(v ORDER BY i) AS t FROM (
        SELECT i, list_reduce(list_prepend(i::BIGINT, list_transform(range(8), lambda k: 0::BIGINT)),
                              lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i))),
ids AS (
    SELECT doc_id, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(str_split(CAST(doc_id AS VARCHAR), ''), lambda c: ord(c)::BIGINT)),
                   lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 3 = 0 AS tampered
    FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL), crc),
fields AS (
    SELECT row_number() OVER () AS r, d.doc_id, d.lang, coalesce(tampered, false) AS tampered, text,
           coalesce(strlen(CAST(d.doc_id AS VARCHAR)) || ':' || d.doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') ||
           coalesce(strlen(d.lang) || ':' || d.lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head
    FROM documents d LEFT JOIN ids USING (doc_id)),
leaves AS (
    SELECT *, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
           CASE WHEN tampered THEN sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS given
    FROM fields),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS number, count(*) OVER (PARTITION BY lang) AS n,
           dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree FROM leaves),
nodes AS (
    SELECT 0 AS level, tree::BIGINT AS tree, number::BIGINT AS number, n::BIGINT AS n, leaf::VARCHAR AS digest FROM ranked
    UNION ALL
    SELECT level + 1, tree, number // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY number)) FROM nodes WHERE n > 1 GROUP BY level, tree, number // 8, n),
tops AS (SELECT 0 AS level, tree::BIGINT AS number, count(*) OVER () AS n, digest FROM nodes WHERE n = 1),
upper_nodes AS (
    SELECT level, number, n::BIGINT AS n, digest::VARCHAR AS digest FROM tops
    UNION ALL
    SELECT level + 1, number // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY number)) FROM upper_nodes WHERE n > 1 GROUP BY level, number // 8, n),
chain AS (
    SELECT r, tree::BIGINT AS tree, 0 AS level, number::BIGINT AS number, n::BIGINT AS n, ''::VARCHAR AS proof, coalesce(given, leaf)::VARCHAR AS acc FROM ranked
    UNION ALL
    SELECT c.r, c.tree, c.level + 1, c.number // 8, (c.n + 7) // 8,
           any_value(c.proof) || coalesce(string_agg(s.digest, '' ORDER BY s.number) FILTER (s.number <> c.number), ''),
           sha256(string_agg(CASE WHEN s.number = c.number THEN c.acc ELSE s.digest END, '' ORDER BY s.number))
    FROM chain c JOIN nodes s ON s.tree = c.tree AND s.level = c.level AND s.number // 8 = c.number // 8
    WHERE c.n > 1 GROUP BY c.r, c.tree, c.level, c.number, c.n),
upper_chain AS (
    SELECT r, 0 AS level, c.tree AS number, t.n::BIGINT AS n, c.proof, c.acc FROM chain c JOIN tops t ON t.number = c.tree WHERE c.n = 1
    UNION ALL
    SELECT c.r, c.level + 1, c.number // 8, (c.n + 7) // 8,
           any_value(c.proof) || coalesce(string_agg(s.digest, '' ORDER BY s.number) FILTER (s.number <> c.number), ''),
           sha256(string_agg(CASE WHEN s.number = c.number THEN c.acc ELSE s.digest END, '' ORDER BY s.number))
    FROM upper_chain c JOIN upper_nodes s ON s.level = c.level AND s.number // 8 = c.number // 8
    WHERE c.n > 1 GROUP BY c.r, c.level, c.number, c.n)
SELECT doc_id, leaf, t.digest AS subroot, u.digest AS root, sha256(c.proof) AS proof_sha256, c.acc AS folded_root, c.acc = u.digest AS verified
FROM ranked k JOIN upper_chain c ON c.r = k.r AND c.n = 1 JOIN tops t ON t.number = k.tree JOIN upper_nodes u ON u.n = 1
"""
