"""N-gram Jaccard join: a grouped prefix join over word shingles.

Two documents link when 100 * intersection >= 80 * union of their sets of distinct 5-word shingles. Steps:

1. One pass counts shingles in a sketch of fixed size and gives each document its set's 128-bit hash. Documents with equal
   sets are one class from here on.
2. Shingles are ordered globally by (frequency class in the sketch, hash), frequent ones last; any global order is valid,
   this one keeps common passages out of prefixes. A set of n shingles has its n - ceil(0.8 n) + 1 first ones as prefix:
   linked sets share a prefix shingle. Classes with identical prefixes and size are collapsed into one group.
3. Group pairs that share a prefix shingle are filtered by size and by the place of the shingle. First only one hub per
   shingle and size band is paired with the others; the links found, and every prefix shingle that more than ``TIED``
   classes hold, tie classes to neighbourhoods. Pairs of different neighbourhoods share only shingles that at most ``TIED``
   classes hold and are paired row by row; a shingle of more than ``HOT`` classes makes only pairs that their whole parities
   allow. Pairs of either kind are verified on the whole sets from the texts where the sizes and parity bits of their sets
   allow a link; only their texts are read. So no shingle makes pairs with the square of its holders, and shingles that the
   sketch could not tell from rare ones don't tie unrelated texts to one neighbourhood, which would send each to many tasks.
4. Inside a neighbourhood every pair counts: its classes are cut by size into blocks, and two blocks (or one with itself)
   whose sizes can meet are compared in one task as a product of 0/1 matrices over their common shingles. A text is read
   once per block pair, not once per pair, so a large group of near copies, or of texts around one passage, is counted
   whole. A neighbourhood of b blocks sends a text to b tasks at most.

A document's links are all other rows whose text links with its own: those of linked classes and of its own class. No
pair is left out: it lies in one neighbourhood and is counted in step 4, or in two and is verified in step 3.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; with fewer than five, the whole sequence is one shingle. Null and
empty texts have empty sets and link with nothing; their component is their own id. A class is known by the 128-bit hash of
its set and gets a number of its own; rows that share a doc_id with different texts are compared each by its own text.
Components and classes are reported by their least doc_id. Null ids link like others but never name a component; the component of
documents without any id is null. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded_batches, entered, freed, numbered, own, restored, scratch_path, stored, table, text_slices
from .components import components
from .decontaminate import maybe_broadcast
from .shingles import mix64, shingle_sets

WIDTH = 5
PERCENT = 80
SKETCH_BITS = 22  # counters of the frequency sketch: 4 million, whatever the input
SLICES = 64
MAX_BROADCAST_IDS = 4_000_000  # ids of 8 bytes
BLOCK_SHINGLES = 1 << 21  # of a block's sets together; a class weighs at least MIN_WEIGHT, so a block has at most 1024
MIN_WEIGHT = 1 << 11
COLUMNS = 4096  # shingles per matrix product
PARITY_BITS = 9  # a set's parity has 512 bits, 8 longs, and finer ones after them if it is large
LEAST_PARITY = (1 << PARITY_BITS) // 64
HOT = 64  # pairs of a prefix shingle of more classes pass the whole parities before they are made
TIED = 1024  # a prefix shingle of more classes ties them to one neighbourhood instead of making their pairs

FIRST = "kind string, doc_id long, row long, n int, s1 long, s2 long, slice int, counts binary"
_MASK = np.uint64((1 << SKETCH_BITS) - 1)


def set_key(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, independent of order."""
    a = mix64(hashes + np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64)
    b = mix64(hashes ^ np.uint64(0xD1B54A32D192ED03)).sum(dtype=np.uint64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def packed(counts: np.ndarray) -> bytes:
    """32-bit counters, compressed byte by byte: a task's counts are small, so the upper bytes are zeros."""
    return pa.compress(np.ascontiguousarray(counts.astype("<u4").view(np.uint8).reshape(-1, 4).T), codec="zstd", asbytes=True)


def unpacked(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, decompressed_size=4 * n, codec="zstd"), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def first_pass(docs: DataFrame, path: str) -> None:
    """Writes kind=set: doc_id, row, n, s1, s2 of every document; kind=sketch: each task's counts, in slices."""
    names = ["kind", "doc_id", "row", "n", "s1", "s2", "slice", "counts"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.uint32)
        for batch in text_slices(batches):
            sets = shingle_sets(batch.column(1).to_pylist(), WIDTH)
            cells, times = np.unique(np.concatenate(sets) & _MASK, return_counts=True)
            counts[cells.astype(np.int64)] += times.astype(np.uint32)
            keys = [set_key(s) for s in sets]
            n = len(sets)
            values = [["set"] * n, batch.column(0), batch.column(2), [len(s) for s in sets], [k[0] for k in keys], [k[1] for k in keys], [None] * n, [None] * n]
            yield pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v, t) for v, t in zip(values, types)], names=names)
        for i, part in enumerate(np.split(counts, SLICES)):
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(["sketch", None, None, None, None, None, i, packed(part)], types)], names=names)

    docs.mapInArrow(run, FIRST).write.partitionBy("kind").option("compression", "zstd").parquet(path)


def frequency_classes(spark: SparkSession, path: str) -> np.ndarray:
    """A small number per counter: 0 for those within the noise, else rising with the count. Fixed size: 4 MB."""
    part = (1 << SKETCH_BITS) // SLICES

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in text_slices(batches, 16):
            for i, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total = sums.setdefault(i, np.zeros(part, np.uint64))
                total += unpacked(data, part)
        yield _classes_only(sums)

    rows = spark.read.schema(FIRST).parquet(path).where("kind = 'sketch'").select("slice", "counts")
    # one step: a second mapInArrow behind it would take a second worker for each task, and executors keep both
    rows = rows.repartition(SLICES, "slice").mapInArrow(add, "slice int, counts binary").collect()
    out = np.zeros(1 << SKETCH_BITS, np.uint8)
    for r in rows:
        out[r["slice"] * part : (r["slice"] + 1) * part] = np.frombuffer(r["counts"], np.uint8)
    return out


def _classes_only(sums: dict[int, np.ndarray]) -> pa.RecordBatch:
    logs = [frequency_class(total.astype(np.float64)).tobytes() for total in sums.values()]
    return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(logs, pa.binary())], names=["slice", "counts"])


def frequency_class(counts: np.ndarray) -> np.ndarray:
    """Of each counter of a slice, by what it has over their mean: the mean, which rises with the input, hides no shingle of a few times its spread."""
    mean = counts.mean()
    over = counts - mean
    return np.where(over <= 4 * np.sqrt(mean) + 8, 0, np.minimum(255, np.floor(4 * np.log2(np.maximum(over, 0) + 1)))).astype(np.uint8)


def parity(hashes: np.ndarray) -> np.ndarray:
    """A bit per bucket of hashes: whether the set has an odd number there. Sets that differ in d shingles differ in at most d bits.

    2**PARITY_BITS buckets come first; sets of more than twice as many shingles go on with twice, four times ... as many
    buckets, to half of their shingles at least.
    """
    bits = PARITY_BITS + max(0, (len(hashes) - 1) >> (PARITY_BITS + 1)).bit_length()
    levels = [np.bincount((hashes >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits).astype(np.uint8) & 1]
    while len(levels[-1]) > 1 << PARITY_BITS:
        levels.append(levels[-1][::2] ^ levels[-1][1::2])
    return np.packbits(np.concatenate(levels[::-1])).view("<i8")


def prefixes(docs: DataFrame, classes: np.ndarray) -> DataFrame:
    """s1, s2, n, doc_id, row, prefix: the first shingles of each non-empty set in the global order, as 64-bit tokens; parity."""
    shared = docs.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequency = shared.value
        for batch in text_slices(batches):
            rows = []
            for doc_id, row, s in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), shingle_sets(batch.column(1).to_pylist(), WIDTH)):
                if n := len(s):
                    size = n - -(-PERCENT * n // 100) + 1
                    token = (frequency[(s & _MASK).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | (mix64(s) >> np.uint64(8))
                    first = np.partition(token, size - 1)[:size] if size < n else token
                    rows.append((*set_key(s), n, doc_id, row, np.sort(first).astype(np.int64), parity(s)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())))],
                names=["s1", "s2", "n", "doc_id", "row", "prefix", "parity"])

    return docs.mapInArrow(run, "s1 long, s2 long, n int, doc_id long, row long, prefix array<long>, parity array<long>")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``pairs``: a, b (classes). ``texts``: cid, text. The linked pairs, by exact shares of whole sets.

    A hub's text is joined to its pairs and split over tasks by the join itself; a pair is one row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, 128):
            one, two = (shingle_sets(batch.column(i).to_pylist(), WIDTH) for i in (2, 3))
            keep = []
            for x, y in zip(one, two):
                same = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * same >= PERCENT * (len(x) + len(y) - same))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    rows = pairs.join(texts.select(F.col("cid").alias("a"), F.col("text").alias("ta")), "a").join(texts.select(F.col("cid").alias("b"), F.col("text").alias("tb")), "b")
    return rows.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def fits(n1: str, p1: str, n2: str, p2: str):
    """Size filter, and place filter: after the first shared shingle enough must remain on both sides."""
    least = F.expr(f"cast(ceil({PERCENT} * ({n1} + {n2}) / {100 + PERCENT}.0) as int)")
    return (F.expr(f"100 * least({n1}, {n2}) >= {PERCENT} * greatest({n1}, {n2})")) & (F.expr(f"least({n1} - {p1}, {n2} - {p2})") >= least)


def near(one: str, n1: str, two: str, n2: str) -> Column:
    """Parity filter: linked sets differ in at most n1 + n2 - 2 * (least common) shingles, so in no more parity bits."""
    least = f"cast(ceil({PERCENT} * ({n1} + {n2}) / {100 + PERCENT}.0) as int)"
    apart = " + ".join(f"bit_count({one}[{i}] ^ {two}[{i}])" for i in range(LEAST_PARITY))
    return F.expr(f"{apart} <= {n1} + {n2} - 2 * {least}")


def nearer(one: str, n1: str, two: str, n2: str) -> Column:
    """The same with the finest buckets that both parities have: those of w longs lie between w - LEAST_PARITY and 2 * w - LEAST_PARITY."""
    least = f"cast(ceil({PERCENT} * ({n1} + {n2}) / {100 + PERCENT}.0) as int)"
    longs = f"least(size({one}), size({two}))"
    apart = f"aggregate(sequence(({longs} - {LEAST_PARITY}) div 2, {longs} - 1L), 0, (s, i) -> s + bit_count({one}[cast(i as int)] ^ {two}[cast(i as int)]))"
    return F.expr(f"{apart} <= {n1} + {n2} - 2 * {least}")


def possible(pairs: DataFrame, of_class: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) that their sizes and parities allow to link; no linked pair is left out, and no text is read."""
    x, y = (of_class.select(F.col("cid").alias(c), F.col("n").alias(f"n_{c}"), F.col("parity").alias(f"parity_{c}")) for c in "ab")
    sizes = F.expr(f"100 * least(n_a, n_b) >= {PERCENT} * greatest(n_a, n_b)")
    return pairs.join(x, "a").join(y, "b").where(sizes & nearer("parity_a", "n_a", "parity_b", "n_b")).select("a", "b")


def crossing(tokens: DataFrame, comps: DataFrame, parities: DataFrame, close: Callable[[str, str, str, str], Column]) -> tuple[DataFrame, DataFrame]:
    """Rows a, b, and the stored table that they come from: classes of different neighbourhoods that share a shingle of ``tokens``
    (gid, n, p, token) and pass the filters by size and place and ``close``, which sees the ``parities`` (cid, parity). A pair
    comes once per shingle."""
    labelled = tokens.join(comps.select(F.col("node").alias("gid"), "comp"), "gid", "left").withColumn("comp", F.coalesce("comp", "gid"))
    mixed = labelled.groupBy("token").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2")).where("c1 <> c2").select("token")
    open_ = stored(labelled.join(mixed, "token", "left_semi").join(parities.withColumnRenamed("cid", "gid"), "gid"), "open")
    x, y = (open_.select("token", *[F.col(c).alias(f"{c}_{s}") for c in ("gid", "n", "p", "comp", "parity")]) for s in "xy")
    # never by broadcast: parities repeat, so the file that the planner goes by is far smaller than its rows
    pairs = x.hint("merge").join(y, (x["token"] == y["token"]) & F.expr("gid_x < gid_y and comp_x <> comp_y") & fits("n_x", "p_x", "n_y", "p_y") & close("parity_x", "n_x", "parity_y", "n_y"))
    return pairs.select(F.col("gid_x").alias("a"), F.col("gid_y").alias("b")), open_


def texts_of(docs: DataFrame, of_class: DataFrame, cids: DataFrame) -> DataFrame:
    """cid, text of the classes in ``cids``, stored: one of a class's rows lends it its text."""
    wanted = cids.distinct().join(of_class.select("cid", "own.row", F.col("own.doc_id").alias("of")), "cid")
    wanted = stored(wanted, "wanted")
    small = wanted.limit(MAX_BROADCAST_IDS + 1).count() <= MAX_BROADCAST_IDS
    texts = docs.where("text is not null").join(F.broadcast(wanted) if small else wanted, [docs["row"] == wanted["row"], docs["doc_id"].eqNullSafe(wanted["of"])])
    texts = stored(texts.select("cid", "text"), "texts")
    if not texts.groupBy("cid").count().where("count > 1").isEmpty():  # repeated rows, with the same text
        texts, repeated = stored(texts.dropDuplicates(["cid"]), "texts"), texts
        freed(docs.sparkSession, repeated)
    return texts


def ends(pairs: DataFrame) -> DataFrame:
    """cid: the classes of ``pairs``."""
    return pairs.select(F.explode(F.array("a", "b")).alias("cid"))


def common(one: list[np.ndarray], two: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each set of ``one`` with each of ``two``, exact."""
    out = np.zeros((len(one), len(two)))
    if one is two:  # a shingle of one set only meets nothing but itself
        values, times = np.unique(np.concatenate(one), return_counts=True)
        shared = values[times > 1]
        np.fill_diagonal(out, [len(x) - np.isin(x, shared, assume_unique=True).sum() for x in one])
    else:
        shared = np.intersect1d(np.concatenate(one), np.concatenate(two))

    def cells(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(column, row) of every shared shingle, by column."""
        values, rows = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        at = np.minimum(np.searchsorted(shared, values), len(shared) - 1)
        keep = shared[at] == values
        order = np.argsort(at[keep], kind="stable")
        return at[keep][order], rows[keep][order]

    if not len(shared):
        return out
    sides = [cells(one), cells(two)]
    for first in range(0, len(shared), COLUMNS):  # a product adds at most COLUMNS ones, exact in 32 bits
        parts = []
        for (column, row), sets in zip(sides, (one, two)):
            lo, hi = np.searchsorted(column, [first, first + COLUMNS])
            part = np.zeros((len(sets), min(COLUMNS, len(shared) - first)), np.float32)
            part[row[lo:hi], column[lo:hi] - first] = 1
            parts.append(part)
        out += parts[0] @ parts[1].T
    return out


def forest(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that span the components of a symmetric relation: at most one less than its members."""
    seen, left, right = np.zeros(len(linked), bool), [], []
    for start in range(len(linked)):
        if seen[start]:
            continue
        seen[start], todo = True, [start]
        while todo:
            at = todo.pop()
            new = np.flatnonzero(linked[at] & ~seen)
            seen[new] = True
            left.append(np.full(len(new), at))
            right.append(new)
            todo += new.tolist()
    return np.concatenate([np.zeros(0, int), *left]), np.concatenate([np.zeros(0, int), *right])


BLOCK_LINKS = "cid long, n_links long, a long, b long"


def block_links(group: pa.Table) -> pa.Table:
    """The links between the classes of two blocks, or inside one: rows (cid, n_links), the rows of the linked classes, and
    rows (a, b), links that span their components."""
    i, j = group["i"][0].as_py(), group["j"][0].as_py()
    cid, blk, rows = (group[c].to_numpy() for c in ("cid", "blk", "rows"))
    sets = shingle_sets(group["text"].to_pylist(), WIDTH)
    sizes = np.array([len(x) for x in sets], np.int64)
    x, y = np.flatnonzero(blk == i), np.flatnonzero(blk == j)
    one = [sets[k] for k in x]
    same = common(one, one if i == j else [sets[k] for k in y]).astype(np.int64)
    linked = 100 * same >= PERCENT * (sizes[x][:, None] + sizes[y][None, :] - same)
    if i == j:
        np.fill_diagonal(linked, False)
        names, n, all_ = cid[x], linked @ rows[y], linked
    else:
        names, n = np.concatenate([cid[x], cid[y]]), np.concatenate([linked @ rows[y], linked.T @ rows[x]])
        all_ = np.zeros((len(names), len(names)), bool)
        all_[: len(x), len(x) :], all_[len(x) :, : len(x)] = linked, linked.T
    a, b = forest(all_)
    counted = n > 0
    none = lambda k: pa.nulls(k, pa.int64())
    return pa.concat_tables([
        pa.table([pa.array(names[counted], pa.int64()), pa.array(n[counted], pa.int64()), none(int(counted.sum())), none(int(counted.sum()))], names=["cid", "n_links", "a", "b"]),
        pa.table([none(len(a)), none(len(a)), pa.array(names[a], pa.int64()), pa.array(names[b], pa.int64())], names=["cid", "n_links", "a", "b"]),
    ])


def blocks_of(nodes: DataFrame) -> DataFrame:
    """``nodes`` (comp, cid, n, rows) with blk: classes of a neighbourhood by size, so many to a block that their sets together
    have at most BLOCK_SHINGLES shingles. Sizes rise with the blocks' numbers."""
    rows = numbered(nodes, ["comp"], ["n", "cid"], "place", "held_")
    band = F.ceil(F.log2(F.greatest(F.col("n"), F.lit(MIN_WEIGHT)))).cast("int")  # no class of the band has more than 2**band
    each = F.greatest(F.lit(BLOCK_SHINGLES) / F.pow(F.lit(2.0), band), F.lit(1.0))
    return rows.select(*nodes.columns, (band.cast("long") * F.lit(1 << 40) + F.floor(F.col("place") / each)).alias("blk"))


def links_inside(comps: DataFrame, found: DataFrame, classes: DataFrame, texts: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """Rows of ``block_links`` of all pairs of the same neighbourhood. ``classes``: cid, n, rows; ``found``: verified links;
    ``only``: neighbourhoods (comp) to look at, by default all."""
    of_comp = stored(comps.groupBy("comp").agg(F.count("*").alias("held")), "held")
    nodes = stored(comps.join(of_comp, "comp").join(classes.select(F.col("cid").alias("node"), "n", "rows"), "node").select(F.col("node").alias("cid"), "comp", "held", "n", "rows"), "nodes")
    # neighbourhoods of two classes: their one link is known
    two = nodes.where("held = 2").select("cid", "rows")
    a, b = (two.select(F.col("cid").alias(c), F.col("rows").alias(f"rows_{c}")) for c in "ab")
    none = F.lit(None).cast("long")
    alone = found.join(a, "a").join(b, "b").select(F.explode(F.array(
        F.struct(F.col("a").alias("cid"), F.col("rows_b").alias("n_links")), F.struct(F.col("b").alias("cid"), F.col("rows_a").alias("n_links")))).alias("x")).select("x.*", none.alias("a"), none.alias("b"))

    many = nodes.where("held > 2").select("comp", "cid", "n", "rows")
    rest = stored(blocks_of(many if only is None else many.join(only, "comp", "left_semi")), "blocks")
    blocks = rest.groupBy("comp", "blk").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    x, y = (blocks.select("comp", *[F.col(c).alias(f"{c}_{s}") for c in ("blk", "least", "most")]) for s in "xy")
    pairs = x.join(y, "comp").where(f"blk_x <= blk_y and 100 * most_x >= {PERCENT} * least_y")  # sizes rise with the blocks
    pairs = pairs.select("comp", F.col("blk_x").alias("i"), F.col("blk_y").alias("j"))
    both = pairs.withColumn("blk", F.explode(F.array_distinct(F.array("i", "j"))))
    members = rest.join(texts, "cid").join(both, ["comp", "blk"]).select("comp", "i", "j", "blk", "cid", "rows", "text")
    return members.groupBy("comp", "i", "j").applyInArrow(block_links, BLOCK_LINKS).unionByName(alone)


def links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counted: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(doc_id, row, n, cid of every document; every class's cid, rows, least doc_id, n_links; node, comp).

    Without ``counted`` n_links is null, and neighbourhoods that no hot shingle ties are not compared in blocks: their
    links are known to connect them."""
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), row_key(id_col, text_col).alias("row"))
    path = scratch_path(spark, "sets")
    first_pass(docs, path)
    sized = prefixes(docs, frequency_classes(spark, path))
    freed(spark, f"{path}/kind=sketch")
    sets = spark.read.schema(FIRST).parquet(path).where("kind = 'set'").select("doc_id", "row", "n", "s1", "s2")

    # classes of equal sets; one of a class's rows lends it its text
    of_class = sized.groupBy("s1", "s2", "n").agg(
        F.min(F.struct("row", "doc_id")).alias("own"), F.min("doc_id").alias("least"), F.count("*").alias("rows"), F.any_value("prefix").alias("prefix"), F.any_value("parity").alias("parity"))
    of_class = stored(of_class.withColumn("cid", F.monotonically_increasing_id()), "classes")
    names = stored(of_class.drop("prefix", "parity"), "names")  # what is needed to the end
    # groups: identical prefix and size; the least class stands for its group
    group_key = [F.xxhash64("prefix"), F.xxhash64(F.lit(7), F.col("prefix")), F.col("n")]
    of_group = of_class.groupBy(*[k.alias(f"g{i}") for i, k in enumerate(group_key)]).agg(F.min("cid").alias("gid"), F.count("*").alias("members"))
    many = stored(of_group.where("members > 1"), "groups")
    members = of_class.select("cid", *[k.alias(f"g{i}") for i, k in enumerate(group_key)]).join(maybe_broadcast(many), ["g0", "g1", "g2"]).select("gid", "cid")
    members = stored(members, "members")
    reps = of_class.join(maybe_broadcast(members.where("gid <> cid").select("cid")), "cid", "left_anti")

    # prefix shingles that at least two groups hold
    tokens = reps.select(F.col("cid").alias("gid"), "n", F.posexplode("prefix").alias("p", "token"))
    tokens = tokens.withColumn("held", F.count("*").over(Window.partitionBy("token"))).where("held > 1").drop("held")
    tokens = stored(tokens, "tokens")
    # members of groups stand beside their representative, with the same shingles
    rest = members.where("gid <> cid")
    if not rest.isEmpty():
        held = maybe_broadcast(rest)
        grouped = of_class.join(maybe_broadcast(members.select("cid")), "cid", "left_semi").select(F.col("cid").alias("gid"), "n", F.posexplode("prefix").alias("p", "token"))
        alone = tokens.join(maybe_broadcast(members.select(F.col("cid").alias("gid"))), "gid", "left_anti")
        tokens, first = stored(alone.unionByName(grouped.select(alone.columns)), "tokens"), tokens
        freed(spark, first)
        star = held.select(F.col("gid").alias("a"), F.col("cid").alias("b"))
    else:
        star = rest.select(F.col("gid").alias("a"), F.col("cid").alias("b"))

    # first pairs: hubs of a shingle and size band, by two orders
    band = F.floor(F.log("n") / F.lit(0.2))
    hubs = tokens.groupBy("token", band.alias("band")).agg(F.min("gid").alias("h1"), F.max("gid").alias("h2"), F.count("*").alias("held")).where("held > 1")
    at_hub = tokens.withColumn("band", band).join(hubs, ["token", "band"])
    hub_pairs = at_hub.select("gid", F.explode(F.array("h1", "h2")).alias("hub")).where("gid <> hub")
    pairs = hub_pairs.select(F.least("gid", "hub").alias("a"), F.greatest("gid", "hub").alias("b")).unionByName(star).distinct()
    pairs = stored(possible(pairs, of_class), "pairs")
    texts = texts_of(docs, names, ends(pairs))
    found = stored(verified(pairs, texts), "links")
    freed(spark, texts)

    # neighbourhoods: verified links, and shingles that very many classes hold
    warm = stored(tokens.groupBy("token").agg(F.count("*").alias("held"), F.min("gid").alias("hub")).where(F.col("held") > HOT), "hot")
    hot = warm.where(F.col("held") > TIED).select("token", "hub")
    tied = tokens.join(hot, "token").where("gid <> hub").select(F.col("hub").alias("a"), F.col("gid").alias("b")).distinct()
    comps = components(found.unionByName(tied))

    # all other pairs: of different neighbourhoods, by shingles that fewer classes hold
    few, open_few = crossing(tokens.join(warm.select("token"), "token", "left_anti"), comps, of_class.select("cid", F.slice("parity", 1, LEAST_PARITY).alias("parity")), near)
    warm = tokens.join(warm.where(F.col("held") <= TIED).select("token"), "token", "left_semi")
    some, open_some = crossing(warm, comps, of_class.select("cid", "parity"), lambda *sides: near(*sides) & nearer(*sides))
    cross = few.unionByName(some).distinct().join(pairs, ["a", "b"], "left_anti")
    cross = stored(possible(cross, of_class), "pairs")
    freed(spark, open_few, open_some, tokens, of_class)

    # texts of these pairs and of the neighbourhoods compared inside
    plain = hot.isEmpty()
    only = None if counted else comps.join(hot.select(F.col("hub").alias("node")).distinct(), "node", "left_semi").select("comp").distinct()
    needed = ends(cross)
    if counted or not plain:
        many = comps.groupBy("comp").agg(F.count("*").alias("held")).where("held > 2").select("comp")
        many = many if only is None else many.join(only, "comp", "left_semi")
        needed = needed.unionByName(comps.join(many, "comp", "left_semi").select(F.col("node").alias("cid")))
    texts = texts_of(docs, names, needed)
    more = stored(verified(cross, texts), "links")
    edges = found.unionByName(more)
    if counted or not plain:
        inside = stored(links_inside(comps, found, names.select("cid", "n", "rows"), texts, only), "inside")
        edges = edges.unionByName(inside.where("a is not null").select("a", "b"))
    freed(spark, texts)
    classes = names.select("cid", "least", "rows", F.lit(None).cast("long").alias("n_links"))
    if counted:
        sides = more.select(F.col("a").alias("cid"), F.col("b").alias("to")).unionByName(more.select(F.col("b").alias("cid"), F.col("a").alias("to")))
        across = sides.join(names.select(F.col("cid").alias("to"), "rows"), "to").select("cid", F.col("rows").alias("n_links"))
        n_links = stored(inside.where("cid is not null").select("cid", "n_links").unionByName(across).groupBy("cid").agg(F.sum("n_links").alias("n_links")), "counts")
        classes = names.select("cid", "least", "rows").join(n_links, "cid", "left").select("cid", "least", "rows", (F.coalesce("n_links", F.lit(0)) + F.col("rows") - 1).alias("n_links"))
    if not (plain and more.isEmpty()):
        comps = components(edges)
    documents = sets.join(names.select("s1", "s2", "n", "cid"), ["s1", "s2", "n"], "left").select("doc_id", "row", "n", "cid")
    return documents, classes, comps


def row_key(id_col: str, text_col: str) -> Column:
    """One long for a row's id and text."""
    return F.xxhash64(F.col(id_col).cast("long"), F.col(text_col))


def labelled_classes(classes: DataFrame, comps: DataFrame) -> DataFrame:
    """``classes`` with comp (its name inside the join) and first (the least doc_id of the component, or null)."""
    out = classes.join(comps.select(F.col("node").alias("cid"), "comp"), "cid", "left")
    first = stored(out.where("comp is not null").groupBy(F.col("comp").alias("c")).agg(F.min("least").alias("of_comp")), "least")
    out = out.join(first, F.col("comp") == F.col("c"), "left")
    return out.withColumn("first", F.when(F.col("comp").isNull(), F.col("least")).otherwise(F.col("of_comp"))).withColumn("comp", F.coalesce("comp", "cid")).drop("c", "of_comp")


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, class_id (documents with the same set), n_links (other rows it links with)."""
    documents, classes, comps = links(docs, id_col, text_col)
    out = documents.join(labelled_classes(classes, comps).drop("comp"), "cid", "left")
    own_id = F.when(F.col("cid").isNull(), F.col("doc_id"))
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("first", own_id).alias("component_id"), F.col("least").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component, with all its columns; empty documents and those without any id stay.

    The row with the least id stays. Rows that share an id are told apart by their texts: of linked or equal ones the one
    with the least text hash stays, texts that don't link all stay. Column names of ``docs`` clash with nothing.
    """
    documents, classes, comps = links(docs, id_col, text_col, counted=False)
    rows = documents.join(labelled_classes(classes, comps).select("cid", "comp", "first"), "cid").where("doc_id is not null")
    rows = stored(rows.select("doc_id", "row", "comp", "first"), "labels")
    kept = rows.where("doc_id = first").groupBy("doc_id", "comp").agg(F.min("row").alias("row"))
    gone = rows.select("doc_id", "row").distinct().join(kept.select("doc_id", "row"), ["doc_id", "row"], "left_anti")
    gone = stored(gone.select(F.col("doc_id").alias("gone_id"), F.col("row").alias("gone_row")), "copies")
    mine = entered(docs)
    name, text = own(docs, id_col), own(docs, text_col)
    key = row_key(name, text)
    out = mine.join(maybe_broadcast(gone, MAX_BROADCAST_IDS), (F.col(name).cast("long") == F.col("gone_id")) & (key == F.col("gone_row")), "left_anti")
    twins = stored(rows.groupBy("doc_id", "row").count().where("count > 1").select(F.col("doc_id").alias("twin_id"), F.col("row").alias("twin_row")), "twins")
    if not twins.isEmpty():  # repeated rows
        same = (F.col(name).cast("long") == F.col("twin_id")) & (key == F.col("twin_row"))
        twins = maybe_broadcast(twins, MAX_BROADCAST_IDS)
        out = out.join(twins, same, "left_anti").unionByName(out.join(twins, same, "left_semi").dropDuplicates([name, text]))
    return restored(out, docs)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"))
