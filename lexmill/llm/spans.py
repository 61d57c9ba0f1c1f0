"""Long exact spans shared between records (problem 9).

1. Seeds: of every window of ``length`` characters the least hash of its k-mers
   is kept (winnowing), so texts with a common stretch of that length have a
   common seed at the same place of it. Seeds of one distinct text only are dropped.
2. Matches: shared seeds are joined, each place with the characters around it, as
   far as a window reaches, so a match is extended to its whole common run there.
   A seed in more than HOT texts, or repeated within one, would give pairs without
   end: it is lengthened to the windows it stands for, by their 128-bit fingerprints.
   Equal fingerprints are equal stretches, so such a seed costs pairs only where
   texts share a whole window, and those only where a common run begins or ends:
   of its windows, at all their places, those two tell the whole run.
3. Chains: the matches of a pair are joined along their diagonals and chained in
   order with gap costs through a Fenwick tree; the gaps of fuzzy passages are
   aligned within a band.

Exact copies are represented by one document and put back at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexmill.session import cut, table

LENGTH = 120
KMER = 32
#: Characters hashed at once in a worker.
SLICE = 1 << 20
#: Places over which the rows of a hot seed are spread.
SALTS = 61
#: Most texts that have a seed, and places of it in one text, for its places to be compared directly.
HOT, REPEATS = 64, 8
#: Pairs of places compared at once in a worker.
PAIRS = 1 << 15
#: Passages: what they are chained of are the common runs of so many characters or more, by seeds of this size.
DENSE, DENSE_KMER = 48, 24
#: Places of a hot window compared in one task; more are compared block by block.
BLOCK = 1 << 14
#: Most edits counted exactly in one gap of a passage.
BAND = 256
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown as needed."""

    def __init__(self, base: int):
        self.base, self.inverse, self.size = np.uint64(base), np.uint64(pow(base, -1, 1 << 64)), 0

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.size:
            self.size = max(n, 2 * self.size)
            self.up = np.cumprod(np.full(self.size, self.base, np.uint64))
            self.down = np.cumprod(np.full(self.size, self.inverse, np.uint64))
        return self.up[:n], self.down[:n]


_POWERS = (_Powers(0x9E3779B97F4A7C15), _Powers(0xD6E8FEB86659FD93))


def _window_hashes(codes: np.ndarray, length: int, which: int = 0) -> np.ndarray:
    """A hash of each window of ``length`` codes (shorter input: none)."""
    n = len(codes)
    if n < length:
        return np.zeros(0, np.uint64)
    up, down = _POWERS[which].get(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_mix(codes + np.uint64(0x9E3779B97F4A7C15 * (which + 1) & 0xFFFFFFFFFFFFFFFF)) * up, out=sums[1:])
    return _mix((sums[length:] - sums[:-length]) * down[: n - length + 1])


def _sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """best (np.minimum or np.maximum) of each run of ``width`` values."""
    n = len(values)
    pad = -n % width
    fill = NONE if best is np.minimum else np.uint64(0)
    grid = np.concatenate([values, np.full(pad, fill, np.uint64)]).reshape(-1, width)
    ahead = best.accumulate(grid, axis=1).ravel()
    back = best.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(back[: n - width + 1], ahead[width - 1 : n])


def _slices(texts: list[str], length: int) -> Iterator[list[int]]:
    """Places of the texts long enough to share a stretch, some SLICE characters at a time."""
    chunk, size = [], 0
    for i, text in enumerate(texts):
        if text is not None and len(text) >= length:
            chunk.append(i)
            size += len(text)
            if size >= SLICE:
                yield chunk
                chunk, size = [], 0
    if chunk:
        yield chunk


def _minima(codes: np.ndarray, sizes: np.ndarray, length: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For concatenated texts: the least k-mer hash of the window at each place (NONE
    where the window leaves its text), the places whose k-mer is the least of some
    window, and their hashes."""
    ends = np.cumsum(sizes)
    kmers = np.minimum(_window_hashes(codes, k), NONE - np.uint64(1))
    width = length - k + 1
    least = _sliding(kmers, width, np.minimum)
    room = np.repeat(ends, sizes)[: len(least)] - np.arange(len(least))
    inside = room >= length
    margin = np.zeros(width - 1, np.uint64)
    # the greatest of the minima of all windows around a place is its own hash only if it is one of them
    around = _sliding(np.concatenate([margin, np.where(inside, least, np.uint64(0)), margin]), width, np.maximum)
    at = np.flatnonzero(kmers == around)
    return np.where(inside, least, NONE), at, kmers[at]


def _codes(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def seeds(docs: DataFrame, length: int = LENGTH, k: int = KMER) -> DataFrame:
    """(doc_id, twin, seed, salt, many): distinct seeds of each document; twin is equal
    for equal texts, many tells that a text has the seed in more than REPEATS places.

    Within a batch, copies of a text are read once, under their least id. A seed
    that several texts of the batch have is known to be shared: two of its rows
    keep the salt 0, by which it is counted, and the rest get other salts, so a
    seed in a third of all texts sends at most two rows a batch to one place.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, twins, texts = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False), batch.column(2).to_pylist()
            order = np.lexsort((ids, twins))
            copies = order[1:][twins[order[1:]] == twins[order[:-1]]]
            for i in copies:
                texts[i] = None
            places, found, often = [], [], []
            for chunk in _slices(texts, length):
                sizes = np.array([len(texts[i]) for i in chunk])
                _, spots, hashes = _minima(_codes([texts[i] for i in chunk]), sizes, length, k)
                owner = np.searchsorted(np.cumsum(sizes), spots, side="right")
                order = np.lexsort((hashes, owner))
                owner, hashes = owner[order], hashes[order]
                first = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])]))
                places.append(np.array(chunk)[owner[first]])
                found.append(hashes[first].view(np.int64))
                often.append(np.diff([*first, len(owner)]) > REPEATS)
            if not places:
                continue
            at, seed, many = np.concatenate(places), np.concatenate(found), np.concatenate(often)
            order = np.argsort(seed, kind="stable")
            at, seed, many = at[order], seed[order], many[order]
            first = np.concatenate([[True], seed[1:] != seed[:-1]])
            nth = np.arange(len(seed)) - np.maximum.accumulate(np.where(first, np.arange(len(seed)), 0))
            salt = np.where(nth < 2, 0, 1 + ids[at] % SALTS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(twins[at]), pa.array(seed), pa.array(salt), pa.array(many)], names=["doc_id", "twin", "seed", "salt", "many"])

    return docs.select("doc_id", "twin", "text").mapInArrow(run, "doc_id bigint, twin bigint, seed bigint, salt int, many boolean")


def spots(docs: DataFrame, length: int = LENGTH, k: int = KMER) -> DataFrame:
    """Places of the seeds listed for each of docs (doc_id, text, seeds array<struct<seed,hot>>).

    A row of a seed that is not hot: key seed, key2 null, pos, near the text around it,
    offset its place there. A row of a window that a hot seed stands for: its
    fingerprint key, key2, pos, before and after the characters next to it (null where
    the next window is none of a hot seed or the text ends), first whether the text has
    it for the first time.
    """
    reach = length - k
    names = ["doc_id", "key", "key2", "pos", "near", "offset", "before", "after", "first"]

    def listed(lists, i: int) -> tuple[np.ndarray, np.ndarray]:
        values = lists[i].values
        seed, hot = values.field(0).to_numpy(zero_copy_only=False).view(np.uint64), values.field(1).to_numpy(zero_copy_only=False)
        return seed[~hot], seed[hot]

    def cold_rows(ids, texts, chunk, start, at, hashes, wanted):
        bounds = np.searchsorted(at, [*start, start[-1] + len(texts[chunk[-1]])])
        docs_, keys, pos, near, offset = [], [], [], [], []
        for j, i in enumerate(chunk):
            if len(wanted[j][0]):
                here = slice(bounds[j], bounds[j + 1])
                hit = np.isin(hashes[here], wanted[j][0])
                for p, h in zip((at[here][hit] - start[j]).tolist(), hashes[here][hit].view(np.int64).tolist(), strict=True):
                    low = max(p - reach, 0)
                    docs_.append(ids[i])
                    keys.append(h)
                    pos.append(p)
                    near.append(texts[i][low : p + k + reach])
                    offset.append(p - low)
        none = pa.nulls(len(docs_), pa.int32())
        columns = [pa.array(docs_, pa.int64()), pa.array(keys, pa.int64()), pa.nulls(len(docs_), pa.int64()), pa.array(pos, pa.int32()), pa.array(near, pa.string()), pa.array(offset, pa.int32()), none, none, pa.nulls(len(docs_), pa.bool_())]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def hot_rows(ids, codes, chunk, start, sizes, least, wanted):
        chosen = np.zeros(len(least), bool)
        for j in range(len(chunk)):
            if len(wanted[j][1]):
                lo, hi = start[j], start[j] + sizes[j] - length + 1
                chosen[lo:hi] = np.isin(least[lo:hi], wanted[j][1])
        at = np.flatnonzero(chosen)
        owner = np.searchsorted(np.cumsum(sizes), at, side="right")
        w1, w2 = (_window_hashes(codes, length, which)[at].view(np.int64) for which in (0, 1))
        order = np.lexsort((at, w2, w1, owner))
        again = (owner[order][1:] == owner[order][:-1]) & (w1[order][1:] == w1[order][:-1]) & (w2[order][1:] == w2[order][:-1])
        first = np.ones(len(at), bool)
        first[order[1:][again]] = False
        chars = codes.astype(np.int32)
        back, ahead = np.concatenate([[False], chosen[:-1]])[at], np.concatenate([chosen[1:], [False]])[at]
        n = len(at)
        columns = [
            pa.array(ids[np.array(chunk)[owner]]), pa.array(w1), pa.array(w2), pa.array((at - start[owner]).astype(np.int32)), pa.nulls(n, pa.string()), pa.nulls(n, pa.int32()),
            pa.array(chars[np.maximum(at - 1, 0)], mask=~back), pa.array(chars[np.minimum(at + length, len(chars) - 1)], mask=~ahead), pa.array(first),
        ]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_pylist(), batch.column(2)
            for chunk in _slices(texts, length):
                sizes = np.array([len(texts[i]) for i in chunk])
                codes = _codes([texts[i] for i in chunk])
                least, at, hashes = _minima(codes, sizes, length, k)
                start = np.cumsum(sizes) - sizes
                wanted = [listed(lists, i) for i in chunk]
                yield cold_rows(ids, texts, chunk, start, at, hashes, wanted)
                if any(len(hot) for _, hot in wanted):
                    yield hot_rows(ids, codes, chunk, start, sizes, least, wanted)

    schema = "doc_id bigint, key bigint, key2 bigint, pos int, near string, offset int, before int, after int, first boolean"
    return docs.select("doc_id", "text", "seeds").mapInArrow(run, schema)


def classes(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, rep): documents long enough, with the least id among their exact copies."""
    keyed = docs.where((F.char_length("text") >= length) & F.col("doc_id").isNotNull()).select("doc_id", F.unhex(F.md5("text")).alias("digest"))
    reps = keyed.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    return keyed.distinct().join(reps, "digest").select("doc_id", "rep")


def shared_spots(docs: DataFrame, members: DataFrame, length: int = LENGTH, k: int = KMER) -> DataFrame:
    """The ``spots`` of class representatives for the seeds that more than one distinct text has, as a written table."""
    docs = docs.where((F.char_length("text") >= length) & F.col("doc_id").isNotNull())
    marked = seeds(docs.select("doc_id", F.xxhash64("text", F.char_length("text")).alias("twin"), "text"), length, k)
    # counted and joined from one exchange: packed in an array, the columns stay the same for both uses
    marked = marked.where("doc_id is not null and twin is not null and seed is not null")
    marked = marked.select("seed", "salt", F.array("doc_id", "twin", F.col("many").cast("long")).alias("who")).repartition("seed", "salt")
    twin = F.col("who")[1]
    shared = marked.groupBy("seed", "salt").agg(F.min(twin).alias("a"), F.max(twin).alias("b")).where("a <> b or salt > 0").select("seed", "salt")
    reps = members.where("doc_id = rep").select("doc_id")
    # an inner join, since a semi join would be moved below the exchange; shared has each key once
    hits = marked.join(shared, ["seed", "salt"]).select(F.col("who")[0].alias("doc_id"), "seed", (F.col("who")[2] > 0).alias("many"))
    hits = cut(hits.join(reps, "doc_id", "left_semi"))
    hot = hits.groupBy("seed").agg(F.count("*").alias("n"), F.bool_or("many").alias("many")).where(F.col("many") | (F.col("n") > HOT)).select("seed", F.lit(True).alias("hot"))
    tagged = hits.join(hot, "seed", "left").select("doc_id", F.struct("seed", F.coalesce("hot", F.lit(False)).alias("hot")).alias("x"))
    lists = tagged.groupBy("doc_id").agg(F.collect_list("x").alias("seeds"))
    return cut(spots(docs.select("doc_id", "text").join(lists, "doc_id"), length, k))


def _around(near: list[str], offset: np.ndarray, k: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """The characters before (nearest first) and behind the k-mer of each place, one row
    each; where the text ends, numbers that no other row has."""
    codes = _codes(near).astype(np.int32)
    sizes = np.array([len(x) for x in near])
    start = np.cumsum(sizes) - sizes
    steps = np.arange(reach)
    missing = (-1 - np.arange(len(near), dtype=np.int32))[:, None]
    back = offset[:, None] - 1 - steps
    ahead = offset[:, None] + k + steps
    left = np.where(back >= 0, codes[start[:, None] + np.maximum(back, 0)], missing)
    right = np.where(ahead < sizes[:, None], codes[start[:, None] + np.minimum(ahead, sizes[:, None] - 1)], missing)
    return left, right


def _same(rows: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many characters the rows i and j begin with in common."""
    differ = rows[i] != rows[j]
    return np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])


def _ends(new: np.ndarray) -> np.ndarray:
    """For each row the end of its group; new tells where a group begins."""
    sizes = np.diff([*np.flatnonzero(new), len(new)])
    return np.repeat(np.cumsum(sizes), sizes)


def _pairs(first: np.ndarray, stop: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each row i with all rows j from first[i] up to stop[i], some PAIRS at once."""
    count = stop - first
    total = np.concatenate([[0], np.cumsum(count)])
    at = 0
    while at < len(count):
        upto = max(at + 1, int(np.searchsorted(total, total[at] + PAIRS, side="right")) - 1)
        i = np.repeat(np.arange(at, upto), count[at:upto])
        yield i, first[i] + np.arange(len(i)) - np.repeat(total[at:upto] - total[at], count[at:upto])
        at = upto


def _matches(batches: Iterator[pa.RecordBatch], length: int, k: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(doc_a, doc_b, pos_a, pos_b, n) of the common runs around the seeds of batches
    (seed, doc_id, pos, offset, near) sorted by seed and doc_id; n is k and what the
    texts have in common before and behind it, as far as a window reaches.

    The places of one seed are at most HOT * REPEATS; they are kept until the next seed comes.
    """
    reach = length - k

    def settled(seed, doc, pos, offset, near):
        left, right = _around(near, offset, k, reach)
        for i, j in _pairs(np.arange(len(seed)) + 1, _ends(np.concatenate([[True], seed[1:] != seed[:-1]]))):
            other = doc[i] != doc[j]
            i, j = i[other], j[other]
            if len(i):
                before = _same(left, i, j)
                yield doc[i], doc[j], pos[i] - before, pos[j] - before, k + before + _same(right, i, j)

    kept = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = [batch.column(c).to_numpy(zero_copy_only=False) for c in range(4)] + [batch.column(4).to_pylist()]
        if kept is not None:
            now = [np.concatenate([x, y]) for x, y in zip(kept[:4], now[:4], strict=True)] + [kept[4] + now[4]]
        done = int(np.searchsorted(now[0], now[0][-1]))
        if done:
            yield from settled(*[x[:done] for x in now])
        kept = [x[done:] for x in now]
    if kept is not None:
        yield from settled(*kept)


def _by_seed(found: DataFrame) -> DataFrame:
    return found.where("key2 is null").select(F.col("key").alias("seed"), "doc_id", "pos", "offset", "near").repartition("seed").sortWithinPartitions("seed", "doc_id")


def _windows(found: DataFrame) -> DataFrame:
    return found.where("key2 is not null").withColumnsRenamed({"key": "w1", "key2": "w2"})


def hot_windows(places: DataFrame) -> DataFrame:
    """(w1, w2, n, begins, ends): fingerprints that stand in more than one text, in n of these
    places; without begins (ends), the run of hot windows goes on alike before (behind) all of them."""
    same = [F.min(c).eqNullSafe(F.max(c)) & (F.count(c) == F.count("*")) for c in ("before", "after")]
    known = places.groupBy("w1", "w2").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.count("*").alias("n"), (~same[0]).alias("begins"), (~same[1]).alias("ends"))
    return known.where("a <> b").drop("a", "b")


def hot_runs(found: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id_a, doc_id_b, pos_a, pos_b, n, side): the first (side 1) and the last window
    (side 2) of all common runs of hot windows, at all places.

    Two places of a window begin a run if the hot windows before them differ or are
    none, and end one likewise, so only places with different neighbours are paired. The
    places of a window are dealt to blocks, of which each two meet in a task.
    """

    def settled(w1, w2, side, low, high, block, near, doc, pos):
        key = np.concatenate([[True], (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1]) | (side[1:] != side[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])])
        group = key | (near < 0) | np.concatenate([[True], near[1:] != near[:-1]])
        for i, j in _pairs(_ends(group), _ends(key)):
            kept = (doc[i] != doc[j]) & ((low[i] == high[i]) | (block[i] != block[j]))
            i, j = i[kept], j[kept]
            i, j = np.where(doc[i] < doc[j], i, j), np.where(doc[i] < doc[j], j, i)
            if len(i):
                columns = [pa.array(doc[i]), pa.array(doc[j]), pa.array(pos[i]), pa.array(pos[j]), pa.array(np.full(len(i), length, np.int32)), pa.array(side[i])]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id_a", "doc_id_b", "pos_a", "pos_b", "n", "side"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = [batch.column(c).to_numpy(zero_copy_only=False) for c in range(9)]
            if kept is not None:
                now = [np.concatenate(c) for c in zip(kept, now, strict=True)]
            other = np.flatnonzero(np.any([c != c[-1] for c in now[:5]], axis=0))
            done = int(other[-1]) + 1 if len(other) else 0
            if done:
                yield from settled(*[c[:done] for c in now])
            kept = [c[done:] for c in now]
        if kept is not None:
            yield from settled(*kept)

    places = _windows(found).select("w1", "w2", "doc_id", "pos", "before", "after")
    many = hot_windows(places).where("begins or ends").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    sides = [F.struct(F.lit(i).alias("side"), F.col(flag).alias("apart"), F.coalesce(c, F.lit(-1)).alias("near")) for i, flag, c in ((1, "begins", "before"), (2, "ends", "after"))]
    outer = places.join(many, ["w1", "w2"]).select("*", F.inline(F.array(*sides))).where("apart")
    block = F.pmod(F.xxhash64("doc_id", "pos"), F.col("blocks")).cast("int")
    dealt = outer.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    keys = ["w1", "w2", "side", "low", "high"]
    dealt = dealt.select("w1", "w2", "side", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "near", "doc_id", "pos")
    return dealt.repartition(*keys).sortWithinPartitions(*keys, "near").mapInArrow(run, "doc_id_a bigint, doc_id_b bigint, pos_a int, pos_b int, n int, side int")


def matches(found: DataFrame, length: int = LENGTH, k: int = KMER, whole: bool = False) -> DataFrame:
    """(doc_id_a, doc_id_b, pos_a, pos_b, n, side): common runs at shared seeds, a < b.

    With whole, those at hot seeds are all of ``hot_runs``, by their first and last
    windows. Without, as is enough to tell the pairs, side is 0 and of a window of
    a hot seed the first place in each text is taken, and of a pair only the windows
    where a run begins or ends: the first window in a text that the other has too
    always is one, so no pair is lost.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for a, b, pos_a, pos_b, n in _matches(batches, length, k):
            columns = [pa.array(a), pa.array(b), pa.array(pos_a.astype(np.int32)), pa.array(pos_b.astype(np.int32)), pa.array(n.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id_a", "doc_id_b", "pos_a", "pos_b", "n"])

    cold = _by_seed(found).mapInArrow(run, "doc_id_a bigint, doc_id_b bigint, pos_a int, pos_b int, n int").withColumn("side", F.lit(0))
    if whole:
        return cold.unionByName(hot_runs(found, length))
    once = _windows(found).where("first").select("w1", "w2", "doc_id", "pos", "before", "after")
    outer = cut(once.join(hot_windows(once).where("begins or ends").select("w1", "w2"), ["w1", "w2"]))
    a, b = (outer.select("w1", "w2", *[F.col(c).alias(f"{c}_{s}") for c in ("doc_id", "pos", "before", "after")]) for s in "ab")
    both = a.join(b, ["w1", "w2"]).where("doc_id_a < doc_id_b")
    edge = ~F.coalesce(F.col("before_a") == F.col("before_b"), F.lit(False)) | ~F.coalesce(F.col("after_a") == F.col("after_b"), F.lit(False))
    return cold.unionByName(both.where(edge).select("doc_id_a", "doc_id_b", "pos_a", "pos_b", F.lit(length).alias("n"), F.lit(0).alias("side")))


class _Fenwick:
    """Greatest (value, item) over a prefix of ranks."""

    def __init__(self, n: int):
        self.tree = [(-1e300, -1)] * (n + 1)

    def put(self, rank: int, value: tuple[float, int]) -> None:
        rank += 1
        while rank < len(self.tree):
            if value > self.tree[rank]:
                self.tree[rank] = value
            rank += rank & -rank

    def best(self, rank: int) -> tuple[float, int]:
        out = (-1e300, -1)
        while rank > 0:
            out = max(out, self.tree[rank])
            rank -= rank & -rank
        return out


def chain(runs: list[tuple[int, int, int]], gap_cost: float = 0.1) -> list[list[int]]:
    """Collinear chains of runs (pos_a, pos_b, length), as lists of their indices.

    A run follows another if it begins at or behind its end in both texts; each
    character of gap costs gap_cost. Each run goes to its best predecessor,
    found among all that end early enough in b by a Fenwick tree over their
    ends, as they are put in by their ends in a. The best chain is taken first,
    and what is left of the others begins where a taken run ends.
    """
    order = sorted(range(len(runs)), key=lambda i: runs[i])
    by_end = sorted(order, key=lambda i: runs[i][0] + runs[i][2])
    stops = sorted({runs[i][1] + runs[i][2] for i in order})
    rank = {stop: r for r, stop in enumerate(stops)}
    tree, score, back, done = _Fenwick(len(stops)), {}, {}, 0
    for i in order:
        a, b, n = runs[i]
        while done < len(by_end) and runs[by_end[done]][0] + runs[by_end[done]][2] <= a:
            j = by_end[done]
            end_a, end_b = runs[j][0] + runs[j][2], runs[j][1] + runs[j][2]
            tree.put(rank[end_b], (score[j] + gap_cost * (end_a + end_b), j))
            done += 1
        upto = int(np.searchsorted(stops, b, side="right"))
        value, j = tree.best(upto)
        gain = value - gap_cost * (a + b)
        score[i], back[i] = (n + gain, j) if j >= 0 and gain > 0 else (float(n), -1)
    taken, chains = set(), []
    for i in sorted(order, key=lambda i: (-score[i], runs[i])):
        links = []
        while i >= 0 and i not in taken:
            taken.add(i)
            links.append(i)
            i = back[i]
        if links:
            chains.append(links[::-1])
    return chains


def _runs_of(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> list[tuple[int, int, int]]:
    """The matches of one pair joined where they touch or overlap on a diagonal."""
    out: list[list[int]] = []
    for i in np.lexsort((a, b - a)):
        x, y, m = int(a[i]), int(b[i]), int(n[i])
        if out and out[-1][1] - out[-1][0] == y - x and out[-1][0] + out[-1][2] >= x:
            out[-1][2] = max(out[-1][2], x + m - out[-1][0])
        else:
            out.append([x, y, m])
    return [tuple(r) for r in out]


def _whole(a: np.ndarray, b: np.ndarray, n: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, ...]:
    """The matches of one pair, those of which the first and the last window came apart put
    together: on a diagonal, each first window goes with the next last one."""
    first, last = (at[np.lexsort((a[at], b[at] - a[at]))] for at in (np.flatnonzero(side == 1), np.flatnonzero(side == 2)))
    there = side == 0
    return np.concatenate([a[there], a[first]]), np.concatenate([b[there], b[first]]), np.concatenate([n[there], a[last] + n[last] - a[first]])


def passages(found: DataFrame, length: int = LENGTH, k: int = KMER, least: int = 0, whole: bool = False) -> DataFrame:
    """Chains of common runs of at least ``least`` characters: doc_id_a, doc_id_b, chain_no, runs array<struct<a,b,n>>.

    found: ``shared_spots``. A pair's matches come to one task, sorted; a pair is bounded by its two texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(key, parts):
            runs = _runs_of(*_whole(*[np.concatenate(c) for c in zip(*parts, strict=True)]))
            return [(*key, no, [dict(zip("abn", runs[i], strict=True)) for i in links]) for no, links in enumerate(chain(runs))]

        def batch_of(rows):
            kind = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int32())])
            x, y, no, runs = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64()), pa.array(no, pa.int32()), pa.array(runs, pa.list_(kind))], names=["doc_id_a", "doc_id_b", "chain_no", "runs"])

        key, parts, rows = None, [], []
        for batch in batches:
            ids_a, ids_b, *rest = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(6))
            if not len(ids_a):
                continue
            bounds = np.flatnonzero((ids_a[1:] != ids_a[:-1]) | (ids_b[1:] != ids_b[:-1])) + 1
            for lo, hi in zip([0, *bounds], [*bounds, len(ids_a)], strict=True):
                here = (int(ids_a[lo]), int(ids_b[lo]))
                if here != key and parts:
                    rows += out(key, parts)
                    parts = []
                    if len(rows) >= 4096:
                        yield batch_of(rows)
                        rows = []
                key = here
                parts.append([c[lo:hi] for c in rest])
        if parts:
            rows += out(key, parts)
        if rows:
            yield batch_of(rows)

    ordered = matches(found, length, k, whole).where(F.col("n") >= least).distinct().repartition("doc_id_a", "doc_id_b").sortWithinPartitions("doc_id_a", "doc_id_b")
    return ordered.mapInArrow(run, "doc_id_a bigint, doc_id_b bigint, chain_no int, runs array<struct<a:int,b:int,n:int>>")


def sharing_pairs(docs: DataFrame, length: int = LENGTH, k: int = KMER) -> DataFrame:
    """(doc_id_a, doc_id_b), a < b: documents with a common stretch of ``length`` characters or more.

    docs: doc_id bigint (unique), text. Null ids, null texts and texts shorter
    than length share nothing; repeated rows count once. The result has all pairs,
    also those among copies, as asked; ``classes`` and ``sharing_classes`` give the
    same knowledge in a size that follows the input.
    """
    members = cut(classes(docs, length))
    reps = sharing_classes(docs, members, length, k)
    a, b = (members.select(F.col("rep").alias(f"doc_id_{s}"), F.col("doc_id").alias(s)) for s in "ab")
    across = reps.join(a, "doc_id_a").join(b, "doc_id_b").select("a", "b")
    inside = members.select("rep", F.col("doc_id").alias("a")).join(members.select("rep", F.col("doc_id").alias("b")), "rep").where("a < b").select("a", "b")
    return across.union(inside).select(F.least("a", "b").alias("doc_id_a"), F.greatest("a", "b").alias("doc_id_b"))


def sharing_classes(docs: DataFrame, members: DataFrame, length: int = LENGTH, k: int = KMER) -> DataFrame:
    """(doc_id_a, doc_id_b): pairs of class representatives whose chains hold a run of ``length`` or more."""
    chains = passages(shared_spots(docs, members, length, k), length, k)
    return chains.where(F.exists("runs", lambda r: r["n"] >= length)).select("doc_id_a", "doc_id_b").distinct()


def shares(docs: DataFrame, length: int = LENGTH, k: int = KMER) -> DataFrame:
    """(doc_id, n_chars, shared_chars, share): how much of each text lies in stretches that stand elsewhere too.

    Every document has a row; null and empty texts have 0 characters and share 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for a, b, pos_a, pos_b, n in _matches(batches, length, k):
            long = n >= length
            stretch = np.unique(np.stack([np.concatenate([a[long], b[long]]), np.concatenate([pos_a[long], pos_b[long]]), np.tile(n[long], 2)]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(stretch[0]), pa.array(stretch[1].astype(np.int32)), pa.array((stretch[1] + stretch[2]).astype(np.int32))], names=["doc_id", "start", "stop"])

    members = cut(classes(docs, length))
    copies = members.groupBy("rep").agg(F.count("*").alias("n_copies"))
    found = shared_spots(docs, members, length, k)
    cold = _by_seed(found).mapInArrow(run, "doc_id bigint, start int, stop int")
    windows = _windows(found)
    windows = windows.join(hot_windows(windows.where("first")).select("w1", "w2"), ["w1", "w2"])
    spans = cold.unionByName(windows.select("doc_id", F.col("pos").alias("start"), (F.col("pos") + length).alias("stop"))).groupBy("doc_id", "start").agg(F.max("stop").alias("stop"))
    # a stretch adds what those before it in the text have not covered yet
    before = F.max("stop").over(Window.partitionBy("doc_id").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    added = F.greatest(F.col("stop") - F.greatest("start", F.coalesce(before, F.lit(0))), F.lit(0))
    covered = spans.select("doc_id", added.alias("new")).groupBy(F.col("doc_id").alias("rep")).agg(F.sum("new").alias("covered"))
    known = members.join(copies, "rep").join(covered, "rep", "left").select("doc_id", "n_copies", "covered")
    size = F.coalesce(F.char_length("text"), F.lit(0))
    rows = docs.select("doc_id", size.cast("long").alias("n_chars")).distinct().join(known, "doc_id", "left")
    shared = F.when(F.col("n_copies") > 1, F.col("n_chars")).otherwise(F.coalesce("covered", F.lit(0))).cast("long")
    return rows.select("doc_id", "n_chars", shared.alias("shared_chars"), F.when(F.col("n_chars") > 0, F.round(shared / F.col("n_chars"), 6)).otherwise(F.lit(0.0)).alias("share"))


def fuzzy_passages(docs: DataFrame, length: int = LENGTH, dense: int = DENSE, k: int = DENSE_KMER) -> DataFrame:
    """Chains of two texts with their gaps aligned: doc_id_a, doc_id_b, start_a,
    end_a, start_b, end_b, n_runs, exact_chars, edits, identity.

    Pairs are pairs of class representatives. A chain is made of common runs of
    ``dense`` characters or more, each of which has a seed, and the stretches between
    them; it is a passage if at least ``length`` characters of its longer side are no
    edit. exact_chars are those of the runs, edits the edit distance of the stretches
    between, exact up to BAND in each, beyond that the longer side of the gap; identity
    is the part of the longer side that is no edit.
    """
    members = cut(classes(docs, dense))
    chains = passages(shared_spots(docs, members, dense, k), dense, k, dense, whole=True)
    first, last = F.col("runs")[0], F.element_at("runs", -1)
    rows = chains.select(
        "doc_id_a", "doc_id_b", "runs", first["a"].alias("start_a"), (last["a"] + last["n"]).alias("end_a"), first["b"].alias("start_b"), (last["b"] + last["n"]).alias("end_b"),
        F.size("runs").alias("n_runs"), F.aggregate("runs", F.lit(0), lambda s, r: s + r["n"]).alias("exact_chars"),
    ).where((F.col("end_a") - F.col("start_a") >= length) | (F.col("end_b") - F.col("start_b") >= length))
    gaps = F.transform(
        F.slice("runs", F.lit(2), F.size("runs")),
        lambda r, i: F.struct(
            (F.col("runs")[i]["a"] + F.col("runs")[i]["n"]).alias("from_a"), r["a"].alias("to_a"), (F.col("runs")[i]["b"] + F.col("runs")[i]["n"]).alias("from_b"), r["b"].alias("to_b")
        ),
    )
    # only chains with a gap need the texts again
    rows = cut(rows)
    gapped = rows.where("n_runs > 1").withColumn("gaps", gaps)
    for s in "ab":
        gapped = gapped.join(docs.select(F.col("doc_id").alias(f"doc_id_{s}"), F.col("text").alias(f"text_{s}")).distinct(), f"doc_id_{s}")

    def distance(g):
        near = F.levenshtein(F.substring(F.col("text_a"), g["from_a"] + 1, g["to_a"] - g["from_a"]), F.substring(F.col("text_b"), g["from_b"] + 1, g["to_b"] - g["from_b"]), BAND)
        return F.when(near >= 0, near).otherwise(F.greatest(g["to_a"] - g["from_a"], g["to_b"] - g["from_b"]))

    edits = F.aggregate("gaps", F.lit(0), lambda n, g: n + distance(g))
    done = gapped.withColumn("edits", edits).drop("gaps", "text_a", "text_b").unionByName(rows.where("n_runs = 1").withColumn("edits", F.lit(0)))
    longer = F.greatest(F.col("end_a") - F.col("start_a"), F.col("end_b") - F.col("start_b"))
    return done.where(longer - F.col("edits") >= length).drop("runs").withColumn("identity", F.round(1 - F.col("edits") / longer, 6))


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")
