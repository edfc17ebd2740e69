"""Language-model scores by a hierarchical Pitman-Yor model, seated by Gibbs sampling."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasteframe.llm.common import U64, WordCodes, blank_words, mix, pieces
from tasteframe.scratch import fresh_path

#: Every FOLDS-th document by crc32 of its id is held out of training.
FOLDS = 10
#: Tokens of a piece of the corpus; a piece holds whole documents, at least one.
PIECE = 4_000_000
#: Documents that are coded in one row.
DOCS_A_ROW = 500
#: Gibbs sweeps, and how many of the first ones are left out of the averages.
SWEEPS, BURN_IN = 4, 2
#: Concentrations of the context restaurants and of the root.
THETA, THETA_ROOT = 1.0, 10.0
#: Up to so many customers of a dish, the distribution of its tables is summed up exactly.
EXACT = 1024
#: Code of the end of a text, and smoothing of the base score.
END, ADD = 0x1E4D0F7E87, 0.1
#: Context restaurants: one for the start of a text, the others shared out to the words before by their codes.
CONTEXTS = 1 << 16


def held_out(doc_id: int | None) -> bool:
    """Whether crc32 of the id as text leaves no remainder; false without id."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLDS == 0


def tokens_of(text: str | None, codes: WordCodes) -> np.ndarray:
    """Codes of the words and one end."""
    return np.append(codes.of(blank_words(text)), U64(END))


def contexts_after(codes: np.ndarray) -> np.ndarray:
    """The restaurant of the words that follow each of these."""
    return (U64(1) + codes % U64(CONTEXTS - 1)).astype(np.uint16)


def context_of_each(after: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Of the tokens of texts of these lengths, one behind the other: what stands before decides; 0 at the start of a text."""
    out = np.concatenate([np.zeros(1, np.uint16), after[:-1]])
    out[np.cumsum(lengths)[:-1]] = 0
    return out


def pairs_of(words: np.ndarray, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct pairs of word number and context, in that order, as one number each; the place of each token's pair)."""
    return np.unique(words * CONTEXTS + contexts, return_inverse=True)


def _pack(x: np.ndarray, width: int = 4) -> bytes:
    """Numbers of ``width`` bytes as byte planes, compressed: small numbers leave planes of zeros."""
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(x.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T).tobytes())


def _unpack(x: bytes, width: int = 4) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(x), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").ravel()


_CODED = (
    "piece long, bucket int, words binary, sizes binary, contexts binary, counts binary, "
    "doc_ids array<long>, held_out array<boolean>, n_tokens array<long>, body binary"
)
_KINDS = [("piece", pa.int64()), ("bucket", pa.int32()), *[(k, pa.binary()) for k in ("words", "sizes", "contexts", "counts")],
          ("doc_ids", pa.list_(pa.int64())), ("held_out", pa.list_(pa.bool_())), ("n_tokens", pa.list_(pa.int64())), ("body", pa.binary())]


def _row(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([columns.get(k)], t) for k, t in _KINDS], [k for k, _ in _KINDS])


def _coded(shift: int):
    """Pieces of the corpus, as rows of three kinds: the distinct words of a bucket (ranges of word codes) with training counts per
    context, the piece's words from frequent to rare, and blocks of documents as ranks among those. Pairs are not kept by
    token: the words give them again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, part, number = WordCodes(), TaskContext.get().partitionId(), 0
        ids: list = []
        made: list[np.ndarray] = []
        size = 0

        def piece() -> Iterator[pa.RecordBatch]:
            name = (part << 24) + number
            words, inverse, n = np.unique(np.concatenate(made), return_inverse=True, return_counts=True)
            order = np.argsort(-n, kind="stable")  # frequent words get small ranks
            rank = np.empty(len(words), np.uint32)
            rank[order] = np.arange(len(words))
            lengths = np.array([len(m) for m in made])
            out = [held_out(i) for i in ids]
            after = contexts_after(words)
            pairs, at = pairs_of(inverse, context_of_each(after[inverse], lengths))
            train = np.bincount(at[np.repeat(~np.array(out), lengths)], minlength=len(pairs))
            ends = np.searchsorted(pairs // CONTEXTS, np.arange(len(words)), "right")
            contexts, sizes = (pairs % CONTEXTS).astype(np.uint16), np.diff(ends, prepend=0)
            buckets, first = np.unique(words >> U64(shift), return_index=True)
            for bucket, a, z in zip(buckets.tolist(), first, [*first[1:], len(words)], strict=True):
                p, q = (ends[a - 1] if a else 0), ends[z - 1]
                yield _row(piece=name, bucket=bucket, words=words[a:z].tobytes(), sizes=_pack(sizes[a:z]), contexts=contexts[p:q].tobytes(), counts=_pack(train[p:q]))
            yield _row(piece=name, words=after[order].tobytes(), body=_pack(order))
            ranks, stops = rank[inverse], np.concatenate([[0], np.cumsum(lengths)])
            for a in range(0, len(ids), DOCS_A_ROW):
                z = min(a + DOCS_A_ROW, len(ids))
                yield _row(piece=name, doc_ids=ids[a:z], held_out=out[a:z], n_tokens=lengths[a:z].tolist(), body=_pack(ranks[stops[a] : stops[z]]))

        for b in pieces(batches):
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids.append(doc_id)
                made.append(tokens_of(text, codes))
                size += len(made[-1])
                if size >= PIECE:
                    yield from piece()
                    ids, made, size, number = [], [], 0, number + 1
        if ids:
            yield from piece()

    return run


_MODEL = "bucket int, words binary, sizes binary, contexts binary, counts binary, pieces array<long>, index array<binary>"


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per bucket: its words with counts summed by context, and for each piece where its pairs stand among them."""
    names = [c.split()[0] for c in _MODEL.split(", ")]
    kinds = [pa.int32(), *[pa.binary()] * 4, pa.list_(pa.int64()), pa.list_(pa.binary())]

    def merge(bucket: int, rows: list[tuple]) -> pa.RecordBatch:
        words, contexts = (np.concatenate([np.frombuffer(r[i], k) for r in rows]) for i, k in ((1, np.uint64), (3, np.uint16)))
        sizes, counts = (np.concatenate([_unpack(r[i]) for r in rows]) for i in (2, 4))
        fresh, at = np.unique(words, return_inverse=True)
        pairs, where = pairs_of(np.repeat(at, sizes), contexts)
        sums = np.zeros(len(pairs), np.uint64)
        np.add.at(sums, where, counts.astype(np.uint64))
        new_sizes = np.bincount(pairs // CONTEXTS, minlength=len(fresh))
        stops = np.cumsum([0, *(len(r[3]) // 2 for r in rows)])  # in a piece, pairs ascend: gaps are small numbers
        index = [_pack(np.diff(where[a:z], prepend=0)) for a, z in zip(stops[:-1], stops[1:], strict=True)]
        values = [bucket, fresh.tobytes(), _pack(new_sizes), (pairs % CONTEXTS).astype(np.uint16).tobytes(), _pack(sums, 8), [r[0] for r in rows], index]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], names)

    now, held = None, []
    for b in batches:
        for bucket, *row in zip(*(_column(b, c).to_pylist() for c in ("bucket", "piece", "words", "sizes", "contexts", "counts")), strict=True):
            if held and bucket != now:
                yield merge(now, held)
                held = []
            now = bucket
            held.append(row)
    if held:
        yield merge(now, held)


def _column(b: pa.RecordBatch, name: str) -> pa.Array:
    return b.column(b.schema.names.index(name))


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(the row's other columns, word codes, row of each pair, its context, its count) of every bucket."""
    for b in batches:
        for i in range(b.num_rows):
            one = {n: b.column(k)[i].as_py() for k, n in enumerate(b.schema.names)}
            sizes = _unpack(one.pop("sizes"))
            words = np.frombuffer(one.pop("words"), np.uint64)
            yield one, words, np.repeat(np.arange(len(words)), sizes), np.frombuffer(one.pop("contexts"), np.uint16), _unpack(one.pop("counts"), 8)


@dataclass(frozen=True)
class Totals:
    """Of all words: training tokens and distinct ones, customers per context, discounts, and tables per context and of the root by sweep."""

    tokens: int
    types: int
    customers: np.ndarray
    discount: float
    root_discount: float
    tables: tuple[np.ndarray, ...]
    root_tables: tuple[float, ...]


_STIRLING: dict[float, np.ndarray] = {}


def log_stirling(discount: float) -> np.ndarray:
    """Logarithms of the generalised Stirling numbers: [n, t] sums, over all seatings of n customers at t tables, the products
    of size - discount that they open with. By S(n + 1, t) = S(n, t - 1) + (n - t * discount) S(n, t)."""
    if discount not in _STIRLING:
        out = np.full((EXACT + 1, EXACT + 1), -np.inf)
        out[1, 1] = 0.0
        t = np.arange(1, EXACT + 1)
        for n in range(1, EXACT):
            stay = out[n, 1 : n + 1] + np.log(n - t[:n] * discount)
            out[n + 1, 1 : n + 1] = np.logaddexp(out[n, :n], stay)
            out[n + 1, n + 1] = out[n, n]
        _STIRLING[discount] = out
    return _STIRLING[discount]


def uniforms(key: np.ndarray, s: int) -> np.ndarray:
    """A number in (0, 1) for each key and sweep: the same wherever and however often the key is seated."""
    with np.errstate(over="ignore"):
        return ((mix(key ^ U64(0x9E3779B97F4A7C15 * (s + 1) & 0xFFFFFFFFFFFFFFFF)) >> U64(11)).astype(np.float64) + 0.5) / 2.0**53


def seat(customers: np.ndarray, weight: np.ndarray, discount: float, key: np.ndarray, s: int) -> np.ndarray:
    """Tables of dishes in Chinese restaurants, a Gibbs step: all customers of a dish are taken out and seated anew given the rest.

    ``weight`` is (concentration + discount * tables of the restaurant) * base probability. The number of tables t of n customers then has
    probability in proportion to weight^t S(n, t), S as in ``log_stirling``: that is where taking them out one by one ends. It is drawn
    by inversion. Beyond EXACT customers the same law, which is that of a Poisson number of tables whose sizes follow a stable law and sum up
    to n, is drawn from its saddle point.
    """
    tables = (customers > 0).astype(np.float64)
    u = uniforms(key, s)
    mean = weight / discount
    upper = np.ceil(1 + mean + 12 * np.sqrt(mean) + 20)  # each further table is less likely than in a Poisson law of this mean
    few = np.flatnonzero((customers > 1) & (customers <= EXACT))
    if len(few):
        few = few[np.argsort(np.minimum(upper[few], customers[few]), kind="stable")]
        log_s, width = log_stirling(discount), np.minimum(upper[few], customers[few]).astype(np.int64)
        at = 0
        while at < len(few):
            end = min(len(few), at + max(1, (1 << 20) // int(width[at])))
            end = min(end, int(np.searchsorted(width, 2 * width[at], "right")))
            some, t = few[at:end], np.arange(1, int(width[end - 1]) + 1)
            p = log_s[customers[some].astype(np.int64)[:, None], t] + t * np.log(weight[some])[:, None]
            p = np.cumsum(np.exp(p - p.max(axis=1, keepdims=True)), axis=1)
            tables[some] = 1 + (p < (u[some] * p[:, -1])[:, None]).sum(axis=1)
            at = end
    many = np.flatnonzero(customers > EXACT)
    if len(many):
        tables[many] = _seat_many(customers[many], weight[many], discount, key[many], s)
    return tables


def _seat_many(n: np.ndarray, weight: np.ndarray, discount: float, key: np.ndarray, s: int) -> np.ndarray:
    """Many customers: sizes are tilted until they sum up to n on average; the tables are then nearly normal, or, if few, one and a Poisson number."""
    low, high = np.full(len(n), -700.0), np.zeros(len(n))  # log(1 - z), with weight * z * (1 - z)^(discount - 1) = n
    for _ in range(60):
        q = (low + high) / 2
        more = np.log(weight) + np.log(-np.expm1(q)) + (discount - 1) * q > np.log(n)
        low, high = np.where(more, q, low), np.where(more, high, q)
    q = np.exp((low + high) / 2)
    mean = weight / discount * (1 - q**discount)
    spread = np.maximum(mean - n / (1 + (1 - discount) * (1 - q) / q), 1e-12)
    normal = sum(uniforms(mix(key + U64(j + 1)), s) for j in range(12)) - 6
    tables = mean + (1 - mean / (mean + 1)) + np.sqrt(spread) * normal
    few = np.flatnonzero(mean < 40)
    if len(few):
        k = np.arange(140)
        p = np.cumsum(np.exp(k * np.log(mean[few])[:, None] - np.cumsum(np.log(np.maximum(k, 1)))[None, :]), axis=1)
        tables[few] = 1 + (p < (uniforms(key[few], s) * p[:, -1])[:, None]).sum(axis=1)
    return np.clip(np.rint(tables), 1, n)


def sweeps(words: np.ndarray, row: np.ndarray, context: np.ndarray, n: np.ndarray, totals: Totals, upto: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(tables per pair, customers per word at the root, tables per word at the root) after each Gibbs sweep of these words.

    Given the tables of all restaurants after the sweep before, words are independent of each other: each sweep seats the
    customers of every pair anew given the root's probability of its word, whose customers are the tables of the contexts. Draws follow
    from the word, its context and the sweep alone, so a repeated task, later passes and any number of buckets see the same seating.
    """
    n = n.astype(np.float64)
    tables = (n > 0).astype(np.float64)
    served = np.bincount(row, tables, len(words))
    several = np.flatnonzero(n > 1)  # a single customer sits at one table, whatever the rest does
    one_each = served - np.bincount(row[several], minlength=len(words))
    row, context, n = row[several], context[several], n[several]
    root = (served > 0).astype(np.float64)
    with np.errstate(over="ignore"):
        pair_key = mix(words[row] + (context.astype(U64) + U64(1)) * U64(0xD1B54A32D192ED03))
    word_key = mix(words)
    for s in range(upto):
        p_root = root_probability(served, root, totals, s)
        weight = (THETA + totals.discount * totals.tables[s][context]) * p_root[row]
        seated = seat(n, weight, totals.discount, pair_key, s)
        tables = tables.copy()
        tables[several] = seated
        served = one_each + np.bincount(row, seated, len(words))
        new = (THETA_ROOT + totals.root_discount * totals.root_tables[s]) / (totals.types + 1)
        root = seat(served, np.full(len(words), new), totals.root_discount, word_key, s)
        yield tables, served, root


def root_probability(served: np.ndarray, root: np.ndarray, totals: Totals, s: int) -> np.ndarray:
    new = (THETA_ROOT + totals.root_discount * totals.root_tables[s]) / (totals.types + 1)
    return (served - totals.root_discount * root + new) / (THETA_ROOT + totals.tables[s].sum())


def _summed(df: DataFrame, fn, names: list[str]) -> dict[str, np.ndarray]:
    """Sums over all batches of vectors of CONTEXTS numbers: at most CONTEXTS rows reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(names), CONTEXTS))
        for _, *x in _buckets(batches):
            total += fn(*x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CONTEXTS)), *[pa.array(t) for t in total]], ["context", *names])

    schema = "context long, " + ", ".join(f"{n} double" for n in names)
    out = {n: np.zeros(CONTEXTS) for n in names}
    columns = df.select("words", "sizes", "contexts", "counts")
    sums = columns.mapInArrow(run, schema).filter(" or ".join(f"{n} <> 0" for n in names)).groupBy("context").agg(*[F.sum(n).alias(n) for n in names]).toArrow()
    for n in names:
        out[n][sums.column("context").to_numpy()] = sums.column(n).to_numpy()
    return out


def _first(words, row, context, n) -> np.ndarray:
    """Customers, types, ones and twos per context; words seen, and those in one and in two contexts, stand in the first cells."""
    def per(w):
        return np.bincount(context, w, CONTEXTS)

    inside = np.bincount(row, n > 0, len(words))
    out = np.stack([per(n.astype(np.float64)), per(n > 0), per(n == 1), per(n == 2), np.zeros(CONTEXTS)])
    out[4, :3] = (inside > 0).sum(), (inside == 1).sum(), (inside == 2).sum()
    return out


def _after(totals: Totals):
    def run(words, row, context, n) -> np.ndarray:
        tables, _, root = list(sweeps(words, row, context, n, totals, len(totals.tables)))[-1]
        out = np.zeros((2, CONTEXTS))
        out[0] = np.bincount(context, tables, CONTEXTS)
        out[1, 0] = root.sum()
        return out

    return run


def _discount(ones: float, twos: float) -> float:
    return float(np.clip(ones / (ones + 2 * twos), 0.05, 0.95)) if ones + twos else 0.5


def train(model: DataFrame) -> Totals:
    """Discounts from the counts of counts of all words, then SWEEPS Gibbs sweeps, one job each. Eager."""
    s = _summed(model, _first, ["customers", "types", "ones", "twos", "words"])
    totals = Totals(
        int(round(s["customers"].sum())), int(s["words"][0]), s["customers"], _discount(s["ones"].sum(), s["twos"].sum()),
        _discount(s["words"][1], s["words"][2]), (s["types"],), (s["words"][0],),
    )
    for _ in range(SWEEPS):
        t = _summed(model, _after(totals), ["tables", "root"])
        totals = Totals(totals.tokens, totals.types, totals.customers, totals.discount, totals.root_discount, (*totals.tables, t["tables"]), (*totals.root_tables, float(t["root"][0])))
    return totals


def predictive(words, row, context, n, totals: Totals) -> np.ndarray:
    """Probability of each pair's word in its context, averaged over the sweeps after BURN_IN."""
    total = np.zeros(len(row))
    for s, (tables, served, root) in enumerate(sweeps(words, row, context, n, totals, SWEEPS), 1):
        if s > BURN_IN:
            p_root = root_probability(served, root, totals, s)
            back = (THETA + totals.discount * totals.tables[s][context]) * p_root[row]
            total += (n - totals.discount * tables + back) / (THETA + totals.customers[context])
    return total / (SWEEPS - BURN_IN)


def _probabilities(totals: Totals):
    """For every piece and bucket, log10 probabilities of its pairs and training counts of its words, both in order."""
    names = ["piece", "bucket", "logp", "counts"]
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one, words, row, context, n in _buckets(batches):
            logp = np.log10(predictive(words, row, context, n, totals)).astype(np.float32)
            count = np.bincount(row, n.astype(np.float64), len(words)).astype(np.uint64)
            for piece, gaps in zip(one["pieces"], one["index"], strict=True):
                i = np.cumsum(_unpack(gaps), dtype=np.int64)
                seen = row[i]
                cells = [piece, one["bucket"], _pack(logp[i].view("<u4")), _pack(count[seen[np.diff(seen, prepend=-1) > 0]], 8)]
                yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(cells, kinds, strict=True)], names)

    return run


_RESULT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def _scored(totals: Totals):
    base_all = totals.tokens + ADD * (totals.types + 1)

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        answers = answers.sort_by("bucket")
        logp = np.concatenate([_unpack(x).view("<f4") for x in answers.column("logp").to_pylist()]).astype(np.float64)
        count = np.concatenate([_unpack(x, 8) for x in answers.column("counts").to_pylist()])
        rows = docs.select(["doc_ids", "held_out", "n_tokens", "words", "body"]).to_pylist()
        listed = next(r for r in rows if r["doc_ids"] is None)
        rows = [r for r in rows if r["doc_ids"] is not None]
        ranks, lengths = np.concatenate([_unpack(r["body"]) for r in rows]), np.concatenate([r["n_tokens"] for r in rows])
        words = _unpack(listed["body"]).astype(np.int64)[ranks]
        _, at = pairs_of(words, context_of_each(np.frombuffer(listed["words"], np.uint16)[ranks], lengths))
        starts = np.cumsum(lengths) - lengths
        base, known = np.log10((count + ADD) / base_all), (count > 0).astype(np.int64)
        return pa.table([
            pa.array([i for r in rows for i in r["doc_ids"]], pa.int64()), pa.array([h for r in rows for h in r["held_out"]], pa.bool_()), pa.array(lengths, pa.int64()),
            pa.array(np.add.reduceat(known[words], starts)), pa.array([totals.tokens] * len(starts), pa.int64()),
            pa.array(np.add.reduceat(base[words], starts)), pa.array(np.add.reduceat(logp[at], starts)),
        ], schema=_RESULT)

    return run


def score(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity), a row per row.

    Tokens are lower-cased (A-Z) runs without ASCII white space and one end; null texts are empty, so they have the end only. The model
    learns from documents whose crc32(doc_id as text) modulo FOLDS is not 0 (without id: they train).

    ``base_score`` is the add-0.1 unigram log10 probability, ``score`` that of a hierarchical Pitman-Yor model: the word before, or
    the start of the text, decides the restaurant, whose tables are customers of one root restaurant over all words, above a uniform base
    of the words seen and one unknown. Words beyond CONTEXTS share context restaurants by their codes, so that sums per context stay bounded. Seats come from Gibbs sampling, the predictive probabilities are averaged over sweeps. ``perplexity`` is
    10 ^ (-score / n_tokens).

    The corpus is coded once: pieces of bounded size hold their distinct words with counts, in buckets of word codes, and blocks of
    documents as ranks into them. A bucket gathers the words of all pieces for the model, and probabilities go back to the pieces; what
    moves is distinct pairs of words per piece, and the words as ranks; the pairs of the tokens follow from the words. There are four buckets per shuffle partition. Probabilities go back in single precision.
    Eager: writes the coded corpus and the model to the shared folder.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shift = 64 - min(24, max(2, (4 * n - 1).bit_length()))
    path = fresh_path(spark, "coded")
    rows.mapInArrow(_coded(shift), _CODED).write.option("compression", "zstd").parquet(path)
    words = spark.read.schema(_CODED).parquet(path).filter("bucket is not null").select("bucket", "piece", "words", "sizes", "contexts", "counts")
    merged = words.repartition(n, "bucket").sortWithinPartitions("bucket", "piece").mapInArrow(_merged, _MODEL)
    model_path = fresh_path(spark, "model")
    merged.write.option("compression", "zstd").parquet(model_path)
    model = spark.read.schema(_MODEL).parquet(model_path)
    totals = train(model)
    answers = model.mapInArrow(_probabilities(totals), "piece long, bucket int, logp binary, counts binary")
    texts = spark.read.schema(_CODED).parquet(path).filter("bucket is null").select("piece", "doc_ids", "held_out", "n_tokens", "words", "body")
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    found = texts.groupBy("piece").cogroup(answers.groupBy("piece")).applyInArrow(_scored(totals), schema)
    return found.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
