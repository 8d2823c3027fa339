"""Near-duplicates by an LSH forest over MinHash signatures.

A text's set are its distinct shingles of words. Texts with equal sets are one
class from the start. Each class has a MinHash signature; each of ``ORDERS``
orders takes the signature's values in another sequence and sorts all classes
by it. Classes next to each other with a common prefix of ``LEAST`` values or
more are candidates. Where a region of the order (classes with one prefix) is
larger than ``REGION``, its depth grows until it is not, so that regions of
common prefixes hold only classes that are ever more alike. Candidates are
of three kinds, and none rests on where an id stands among the others:

- in a region, the classes are the nodes of a tree of pairs that agree in the
  most values of the whole signatures, so there is a pair less than classes;
  each class is also paired with the least id of the run of classes so far that
  share ``LEAST`` values, and all classes of a region of up to 4 are paired;
- of all other pairs of a region, those that agree in ``NEAR`` values or more
  and are in two components yet are candidates; they are compared where the sets
  of their region meet, so that each class is sent there once, and not for each
  of its pairs;
- in runs that are larger than a region, classes that are in another component
  yet are paired with the class of the run that has the most links: the text
  that very many copies were made from is alike to all of them.

Candidates are held against each other on full sets: 100 * intersection >= 80 *
union. Links make components; a text's class id is the least id it reaches.

Pairs that are in one component already need no comparison, and the regions are
bounded, so the pairs are linear in the rows. The order is range-partitioned with the id as the last key, so that a
prefix that very many classes share is spread over tasks; classes on either
side of a boundary between tasks are paired through a table of boundary rows.

Defined results: texts without a word and null texts have an empty set, link
with nothing and are their own component; a text of fewer words than a shingle
has its whole sequence as the one shingle; rows with one id are one document;
a null id is kept and has no component.
"""

from __future__ import annotations

import functools
import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigora.llm.common import bounded_batches, checkpointed, forget, map_arrow, release, table, trim
from vigora.llm.components import components, follows

HASHES, ORDERS, DEPTH, LEAST, REGION, WINDOW, SEED = 64, 32, 12, 5, 64, 2, 8
#: Values of two signatures that agree, for a pair to be near the threshold: 51 on average at 0.8, with a deviation of 3.2.
NEAR = 40
PERCENT, MEMBERS = 80, 256
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U(31))
    x = x * _U(0x9E3779B97F4A7C15)
    x = x ^ (x >> _U(29))
    x = x * _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(32))


class Shingler:
    """Sorted distinct shingle hashes (64 bits) of many texts at once."""

    def __init__(self, size: int):
        import xxhash

        self.size, self.digest = size, xxhash.xxh3_64_intdigest
        self.factors = np.random.default_rng(SEED).integers(1, 2**63, size=size, dtype=np.uint64) * _U(2) + _U(1)

    def sets(self, texts: list[str | None]) -> list[np.ndarray]:
        split = [(t or "").encode("utf-8", "surrogatepass").lower().split() for t in texts]
        counts = [len(w) for w in split]
        words = np.fromiter(map(self.digest, itertools.chain.from_iterable(split)), np.uint64, sum(counts))
        n, s = len(words), self.size
        grams = np.zeros(max(0, n - s + 1), np.uint64)
        with np.errstate(over="ignore"):
            for k in range(s):
                grams += words[k : n - s + 1 + k] * self.factors[k]
            grams = _mix(grams)
            out, at = [], 0
            for c in counts:
                if c >= s:
                    out.append(np.unique(grams[at : at + c - s + 1]))
                elif c:
                    short = (words[at : at + c] * self.factors[:c]).sum(dtype=np.uint64) + _U(c)
                    out.append(_mix(np.array([short], np.uint64)))
                else:
                    out.append(np.zeros(0, np.uint64))
                at += c
        return out


def _permutations() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED + 1)
    return rng.integers(0, 2**63, size=HASHES, dtype=np.uint64), rng.integers(1, 2**62, size=HASHES, dtype=np.uint64) * _U(2) + _U(1), np.stack([rng.permutation(HASHES)[:DEPTH] for _ in range(ORDERS)])


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """16 bits of each of ``HASHES`` minima, for sets that are not empty."""
    xors, factors, _ = _permutations()
    flat, starts = np.concatenate(sets), np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), HASHES), np.uint16)
    with np.errstate(over="ignore"):
        for k in range(HASHES):
            least = np.minimum.reduceat((flat ^ xors[k]) * factors[k], starts)
            out[:, k] = (_mix(least) >> _U(48)).astype(np.uint16)
    return out


def describe(documents: DataFrame, size: int) -> DataFrame:
    """doc_id, n (set size), fp (128 bits of the set; null if empty), sig (the signature)."""

    def make():
        shingler = Shingler(size)

        def f(c):
            sets = shingler.sets(c["text"])
            full = [s for s in sets if len(s)]
            sigs = iter(signatures(full).astype(">u2") if full else [])
            made = [(hashlib.md5(s.tobytes()).digest(), next(sigs).tobytes()) if len(s) else (None, None) for s in sets]
            return {"doc_id": c["doc_id"], "n": [len(s) for s in sets], "fp": [a for a, _ in made], "sig": [b for _, b in made]}
        return f

    return map_arrow(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), make, "doc_id long, n long, fp binary, sig binary", rows=256)


class _Region:
    """Rows of one order as they come sorted; gives candidate pairs, regions and runs larger than one; holds REGION rows of each at most."""

    def __init__(self, emit, block=None, member=None):
        self.emit, self.rows, self.depth, self.first = emit, [], LEAST, None
        self.block, self.member = block, member or (lambda row: None)
        # The first run may have begun in the task before: given whole, however short.
        self.run, self.start, self.large = [], None, True

    @staticmethod
    def common(a: bytes, b: bytes) -> int:
        n = 0
        while n < DEPTH and a[2 * n : 2 * n + 2] == b[2 * n : 2 * n + 2]:
            n += 1
        return n

    def chain(self, rows):
        # A chain of WINDOW and the least id are all pairs of fewer rows.
        if self.block and len(rows) > WINDOW + 2:
            for a, b in self.block(rows):
                self.emit(rows[a], rows[b])
            return
        for gap in range(1, WINDOW + 1):
            for a, b in zip(rows, rows[gap:]):
                self.emit(a, b)
        rows = sorted(rows, key=lambda r: r[1])
        for gap in range(1, WINDOW + 1):
            for a, b in zip(rows, rows[gap:]):
                self.emit(a, b)
        for b in rows[WINDOW + 1 :]:
            self.emit(rows[0], b)

    def follow(self, row):
        """The run of rows that share LEAST values."""
        if self.start is None or self.common(self.start, row[0]) < LEAST:
            if self.start is not None:
                self.end_run(self.large)
            self.start = row[0]
        self.run.append(row)
        self.large = self.large or len(self.run) > REGION
        if len(self.run) > REGION:
            self.end_run(True, True)

    def end_run(self, given: bool, large: bool = False):
        if given:
            for row in self.run:
                self.member(row)
        self.run, self.large = [], large

    def add(self, key: bytes, rep: int, n: int, sig: bytes = b""):
        row, shared = (key, rep, n, sig), -1
        self.follow(row)
        if self.rows:
            shared = self.common(self.rows[-1][0], key)
            if shared < self.depth:
                last = self.rows[-1]
                self.flush()
                if shared >= LEAST:
                    self.emit(last, row)
        if self.first is None or self.common(self.first[0], key) < LEAST:
            self.first = row
        elif rep < self.first[1]:
            for other in (self.first, *self.rows):
                self.emit(row, other)
            self.first = row
        else:
            self.emit(self.first, row)
        self.rows.append(row)
        while len(self.rows) > REGION:
            if self.depth < DEPTH:
                # The region is too large: one value deeper, only the last part stays open.
                self.depth += 1
                parts, at = [], 0
                for k in range(1, len(self.rows)):
                    if self.common(self.rows[k - 1][0], self.rows[k][0]) < self.depth:
                        parts.append(self.rows[at:k])
                        at = k
                for part, after in zip(parts, [*parts[1:], self.rows[at:]]):
                    self.chain(part)
                    self.emit(part[-1], after[0])
                self.rows = self.rows[at:]
            else:
                keep = self.rows[-WINDOW:]
                self.chain(self.rows)
                self.rows = keep
                break

    def flush(self):
        self.chain(self.rows)
        self.rows, self.depth = [], LEAST

    def close(self):
        """The end of an order."""
        self.flush()
        if self.start is not None:
            self.end_run(self.large)
        self.first = self.start = None


def near_rows(rows) -> tuple[list[tuple[int, int]], list[tuple[int, int, bytes]]]:
    """For the rows of a region: the pairs of positions of a tree of the likest; and position, id and bits of the other partners near the threshold, for each row that has some."""
    sigs, n = np.frombuffer(b"".join(r[3] for r in rows), np.uint8).reshape(len(rows), HASHES), np.array([r[2] for r in rows])
    like = (sigs[:, None] == sigs[None]).sum(axis=2)
    fits = 100 * np.minimum(n[:, None], n[None]) >= PERCENT * np.maximum(n[:, None], n[None])
    # Pairs whose sizes cannot fit join only what nothing else does; ``emit`` drops them.
    pairs, likest = tree(np.where(fits, like, -1)), fits & (like >= NEAR)
    np.fill_diagonal(likest, False)
    for a, b in pairs:
        likest[a, b] = likest[b, a] = False
    bits = np.packbits(likest, axis=1)
    return pairs, [(int(k), rows[k][1], bits[k].tobytes()) for k in np.flatnonzero(likest.any(axis=1))]


def tree(like: np.ndarray) -> list[tuple[int, int]]:
    """The pairs of a spanning tree with the largest sum of ``like`` (symmetric)."""
    best, at, pairs = like[0].copy(), np.zeros(len(like), np.intp), []
    best[0] = -2
    for _ in range(len(like) - 1):
        k = int(best.argmax())
        pairs.append((int(at[k]), k))
        # -2: in the tree.
        better = (like[k] > best) & (best > -2)
        best[better], at[better], best[k] = like[k][better], k, -2
    return pairs


PAIR = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType()), T.StructField("edge", T.IntegerType()), T.StructField("part", T.IntegerType()), T.StructField("ord", T.IntegerType()), T.StructField("key", T.BinaryType()), T.StructField("n", T.LongType())])


#: Kinds of rows in PAIR.edge beside borders (0 and more) and pairs (null).
RUN, BLOCK = -1, -2


def candidates(classes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pairs of class representatives (a < b), rows of regions (block, pos, rep, bits), rows of large runs (ord, key, rep, n); classes: rep, n, sig."""
    orders = _permutations()[2]
    low = F.concat(*[F.substring("sig", 2 * k + 2, 1) for k in range(HASHES)])
    rows = classes.withColumn("low", low).select("rep", "n", "low", F.posexplode(F.array(*[F.concat(*[F.substring("sig", 2 * int(i) + 1, 2) for i in o]) for o in orders])).alias("ord", "key"))
    parts = rows.sparkSession.conf.get("spark.sql.shuffle.partitions")
    ranged = rows.repartitionByRange(int(parts), "ord", "key", "rep").sortWithinPartitions("ord", "key", "rep")

    def run(batches):
        from pyspark import TaskContext

        forget()
        pid = TaskContext.get().partitionId()
        a_s, b_s, more, blocks = [], [], [], itertools.count(pid << 32)

        def emit(x, y):
            if x[1] != y[1] and 100 * min(x[2], y[2]) >= PERCENT * max(x[2], y[2]):
                a_s.append(min(x[1], y[1]))
                b_s.append(max(x[1], y[1]))

        def block(rows):
            pairs, found = near_rows(rows)
            number = next(blocks) if found else None
            more.extend((rep, number, BLOCK, pos, None, bits, None) for pos, rep, bits in found)
            return pairs

        def member(row):
            more.append((row[1], None, RUN, None, order, row[0][: 2 * LEAST], row[2]))

        def made(rows_out):
            return pa.RecordBatch.from_pydict({k: pa.array([r[i] for r in rows_out], t) for i, (k, t) in enumerate((("a", pa.int64()), ("b", pa.int64()), ("edge", pa.int32()), ("part", pa.int32()), ("ord", pa.int32()), ("key", pa.binary()), ("n", pa.int64())))})

        region, order, first, last = _Region(emit, block, member), None, [], []
        for batch in batches:
            for rep, n, o, key, sig in zip(*(batch.column(batch.schema.get_field_index(x)).to_pylist() for x in ("rep", "n", "ord", "key", "low"))):
                if o != order:
                    region.close()
                    order = o
                region.add(key, rep, n, sig)
                if len(first) < WINDOW:
                    first.append((rep, None, len(first), pid, o, key, n))
                last = [*last[-WINDOW + 1 :], (rep, None, 0, pid, o, key, n)]
            if len(a_s) + len(more) > 100_000:
                yield made([(a, b, None, None, None, None, None) for a, b in dict.fromkeys(zip(a_s, b_s))] + more)
                a_s.clear(), b_s.clear(), more.clear()
            trim()
        region.flush()
        # The last run may go on in the next task.
        region.end_run(True)
        ends = first + [(r[0], None, WINDOW + k, *r[3:]) for k, r in enumerate(last)]
        yield made([(a, b, None, None, None, None, None) for a, b in dict.fromkeys(zip(a_s, b_s))] + more + ends)

    bounded_batches(classes.sparkSession)
    found = checkpointed(ranged.mapInArrow(run, PAIR))
    # The last rows of each task and the first of the next: 2 * WINDOW rows a task, so few enough for the driver.
    ends = sorted(((r.part, r.edge, r.a, r.ord, bytes(r.key), r.n) for r in found.where("edge >= 0").collect()))
    border = set()
    for x, y in ((x, y) for k, x in enumerate(ends) for y in ends[k + 1 : k + 1 + 2 * WINDOW]):
        if x[2] != y[2] and x[3] == y[3] and _Region.common(x[4], y[4]) >= LEAST and 100 * min(x[5], y[5]) >= PERCENT * max(x[5], y[5]):
            border.add((min(x[2], y[2]), max(x[2], y[2])))
    pairs = found.where("edge IS NULL").select("a", "b")
    if border:
        pairs = pairs.union(classes.sparkSession.createDataFrame(sorted(border), "a long, b long"))
    regions = found.where(F.col("edge") == BLOCK).select(F.col("b").alias("block"), F.col("part").alias("pos"), F.col("a").alias("rep"), F.col("key").alias("bits"))
    runs = found.where(F.col("edge") == RUN).select("ord", "key", F.col("a").alias("rep"), "n")
    return pairs.distinct(), regions, runs


def _placed(rows: DataFrame, linked: DataFrame) -> DataFrame:
    """``rows`` with the component of each ``rep``."""
    return rows.join(linked, F.col("rep") == F.col("node"), "left").withColumn("component", F.coalesce("component", "rep")).drop("node")


def apart(regions: DataFrame, linked: DataFrame) -> DataFrame:
    """block, pos, rep, bits: rows of regions with the partners that are near the threshold and in another component."""
    groups = (
        _placed(regions, linked).groupBy("block").agg(F.min("component").alias("least"), F.max("component").alias("most"), F.collect_list(F.struct("pos", "rep", "bits", "component")).alias("rows"))
        .where("least <> most").select("block", "rows")
    )

    def make():
        def f(c):
            out = []
            for block, rows in zip(c["block"], c["rows"]):
                of = {r["pos"]: r["component"] for r in rows}
                for r in rows:
                    bits = np.unpackbits(np.frombuffer(r["bits"], np.uint8))
                    for p in np.flatnonzero(bits).tolist():
                        bits[p] = of[p] != r["component"]
                    if bits.any():
                        out.append((block, r["pos"], r["rep"], np.packbits(bits).tobytes()))
            return {k: [r[i] for r in out] for i, k in enumerate(("block", "pos", "rep", "bits"))}
        return f

    return map_arrow(groups, make, "block long, pos int, rep long, bits binary", rows=64)


def common_sizes(sets: list[np.ndarray], wide: int = 1 << 16) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets; laid out ``wide`` values at a time."""
    own, flat = np.repeat(np.arange(len(sets)), [len(s) for s in sets]), np.concatenate(sets)
    _, column, times = np.unique(flat, return_inverse=True, return_counts=True)
    order = np.argsort(column[keep := np.flatnonzero(times[column] > 1)], kind="stable")
    own, column = own[keep][order], column[keep][order]
    column = np.cumsum(np.r_[False, column[1:] != column[:-1]][: len(column)])
    both = np.zeros((len(sets), len(sets)), np.int64)
    for k in range(0, int(column[-1]) + 1 if len(column) else 0, wide):
        a, b = np.searchsorted(column, (k, k + wide))
        laid = np.zeros((len(sets), int(column[b - 1]) + 1 - k), np.float32)
        laid[own[a:b], column[a:b] - k] = 1
        both += (laid @ laid.T).astype(np.int64)
    both[np.diag_indices(len(sets))] = [len(s) for s in sets]
    return both


def compare(documents: DataFrame, rows: DataFrame, size: int) -> DataFrame:
    """a, b: the pairs of ``rows`` (of ``apart``) that hold on full sets; a class is in a region of each order, so it is sent to about ORDERS regions at most."""
    wanted = rows.groupBy("rep").agg(F.collect_list(F.struct("block", "pos", "bits")).alias("blocks"))
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted, F.col("doc_id") == F.col("rep")).select("doc_id", "text", "blocks")

    def make():
        shingler = Shingler(size)

        def f(c):
            sets = [s.tobytes() for s in shingler.sets(c["text"])]
            found = [(x["block"], x["pos"], x["bits"], d, s) for d, s, xs in zip(c["doc_id"], sets, c["blocks"]) for x in xs]
            return {k: [r[i] for r in found] for i, k in enumerate(("block", "pos", "bits", "doc_id", "shingles"))}
        return f

    def check(tables):
        # Rows of one id have one place; the first text of them counts.
        at = {}
        for pos, *row in zip(*(tables.column(k).to_pylist() for k in ("pos", "doc_id", "bits", "shingles"))):
            at.setdefault(pos, row)
        places, rows = list(at), list(at.values())
        sets = [np.frombuffer(r[2], np.uint64) for r in rows]
        both, n, number = common_sizes(sets), np.array([len(s) for s in sets]), {p: k for k, p in enumerate(places)}
        linked = 100 * both >= PERCENT * (n[:, None] + n[None] - both)
        out = set()
        for k, (rep, bits, _) in enumerate(rows):
            for p in np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8))).tolist():
                if p in number and linked[k, number[p]]:
                    out.add((min(rep, rows[number[p]][0]), max(rep, rows[number[p]][0])))
        trim()
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})

    sets = map_arrow(texts, make, "block long, pos int, bits binary, doc_id long, shingles binary", rows=64)
    return sets.groupBy("block").applyInArrow(check, "a long, b long").distinct()


def to_hubs(runs: DataFrame, links: DataFrame, linked: DataFrame) -> DataFrame:
    """a, b: rows of large runs and the class of their run that has the most links, where they are in two components."""
    degrees = links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep", follows("rep")).agg(F.count("*").alias("links")).drop("_follows")
    rows = checkpointed(_placed(runs.join(degrees, "rep", "left"), linked))
    hubs = rows.groupBy("ord", "key").agg(F.max(F.struct(F.coalesce("links", F.lit(0)).alias("links"), (-F.col("rep")).alias("last"), F.col("n"), F.col("component"))).alias("hub"))
    met = rows.join(hubs, ["ord", "key"]).where((F.col("component") != F.col("hub.component")) & (100 * F.least("n", "hub.n") >= PERCENT * F.greatest("n", "hub.n")))
    return met.select(F.least(F.col("rep"), -F.col("hub.last")).alias("a"), F.greatest(F.col("rep"), -F.col("hub.last")).alias("b")).distinct()


def confirm(documents: DataFrame, pairs: DataFrame, size: int) -> DataFrame:
    """The pairs that hold on full sets.

    Pairs meet at the end that has more pairs, the center. Each text's set is sent once for
    each of its centers; a center's own set goes to each of the groups of about
    ``MEMBERS`` sets that its partners are dealt to, so that the text of which
    very many are copies is compared in many tasks.
    """
    ends = pairs.select(F.explode(F.array("a", "b")).alias("end")).groupBy("end", follows("end")).agg(F.count("*").alias("pairs"))
    sides = [ends.select(F.col("end").alias(x), F.col("pairs").alias(f"{x}_pairs")) for x in ("a", "b")]
    swap = F.col("b_pairs") > F.col("a_pairs")
    # A center's groups follow from all its pairs, also those that meet at their other end: no other join tells how many are its own.
    groups = F.ceil(F.greatest("a_pairs", "b_pairs") / MEMBERS).cast("int")
    members = pairs.join(sides[0], "a").join(sides[1], "b").select(
        F.when(swap, F.col("a")).otherwise(F.col("b")).alias("doc_id"), F.lit(0).alias("bucket"), F.when(swap, F.col("b")).otherwise(F.col("a")).alias("center"),
        F.pmod(F.xxhash64(F.when(swap, F.col("a")).otherwise(F.col("b"))), groups).cast("int").alias("grp"),
    )
    owners = members.select(F.col("center").alias("doc_id"), "grp", "center").distinct().withColumn("bucket", (F.col("grp") / 64).cast("int"))
    # As a member a class has no more centers than pairs, each with as many pairs or more; as a center 64 groups in each bucket.
    wanted = members.unionByName(owners).groupBy("doc_id", "bucket").agg(F.collect_list(F.struct("center", "grp")).alias("centers"))
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted.drop("bucket"), "doc_id")

    def make():
        shingler = Shingler(size)

        def f(c):
            sets = shingler.sets(c["text"])
            rows = [(x["center"], x["grp"], d, s.tobytes()) for d, s, cs in zip(c["doc_id"], sets, c["centers"]) for x in cs]
            return {"center": [r[0] for r in rows], "grp": [r[1] for r in rows], "doc_id": [r[2] for r in rows], "shingles": [r[3] for r in rows]}
        return f

    sets = map_arrow(texts, make, "center long, grp int, doc_id long, shingles binary", rows=64)

    def check(key, tables):
        """One group of a center: its own set against the others'."""
        center = key[0].as_py()
        own, others = None, {}
        for d, s in zip(tables.column("doc_id").to_pylist(), tables.column("shingles").to_pylist()):
            s = np.frombuffer(s, np.uint64)
            if d == center:
                own = s
            else:
                others[d] = s
        out = []
        if own is not None:
            for d, s in others.items():
                both = len(np.intersect1d(own, s, assume_unique=True))
                if 100 * both >= PERCENT * (len(own) + len(s) - both):
                    out.append(d)
        trim()
        return pa.table({"a": pa.array([center] * len(out), pa.int64()), "b": pa.array(out, pa.int64())})

    return sets.groupBy("center", "grp").applyInArrow(check, "a long, b long")


def find(documents: DataFrame, size: int = 2) -> DataFrame:
    """doc_id, n_shingles, component_id, kept; a row for each row."""
    described = checkpointed(describe(documents, size))
    classes = checkpointed(described.where("fp IS NOT NULL AND doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sig").alias("sig")))
    pairs, regions, runs = candidates(classes)
    pairs = checkpointed(pairs)
    release(documents.sparkSession)
    links = checkpointed(confirm(documents, pairs, size))
    release(documents.sparkSession)
    linked = components(links)
    rest, hubs = checkpointed(apart(regions, linked)), checkpointed(to_hubs(runs, links, linked))
    release(documents.sparkSession)
    # What is linked already goes on as stars, a pair less than classes.
    stars, further = linked.select(F.col("component").alias("a"), F.col("node").alias("b")), []
    if not rest.isEmpty():
        further.append(compare(documents, rest, size))
    if not hubs.isEmpty():
        further.append(confirm(documents, hubs, size))
    if further:
        linked = components(functools.reduce(DataFrame.union, further, stars))
    classed = classes.select("fp", "rep").join(linked, F.col("rep") == F.col("node"), "left").select("fp", F.coalesce("component", "rep").alias("component"))
    return (
        described.select("doc_id", "n", "fp").join(classed, "fp", "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def op8_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"), 2)


def keep_one(documents: DataFrame, size: int) -> DataFrame:
    """The rows of ``documents`` without near copies: of each component the row with its id; of rows with one id, one."""
    found = checkpointed(find(documents, size))
    ids = found.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n"), F.max("component_id").alias("c"))
    goes = ids.where("c <> doc_id").select("doc_id")
    again = ids.where("n > 1 AND c = doc_id").select("doc_id")
    kept = documents.join(goes, "doc_id", "left_anti").select(*documents.columns)
    if again.isEmpty():
        return kept
    single = kept.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(*documents.columns)
    return kept.join(again, "doc_id", "left_anti").select(*documents.columns).unionByName(single)
