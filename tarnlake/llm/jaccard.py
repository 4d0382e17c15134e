"""N-gram Jaccard join: size-aware, heavy and light."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnlake.llm.arrow import whole_groups
from tarnlake.llm.components import connected_components
from tarnlake.llm.scratch import importable, keep, release
from tarnlake.llm.words import distinct_sorted, mix, shingle_hashes, text_runs, word_hashes

#: Bits of a set's parity sketch: the power of two from twice its size, within these bounds.
LEAST_BITS, MOST_SKETCH = 256, 8192
#: Shingles in more prefixes than this come last in the common order; of more than so many, those in the most prefixes.
FREQUENT, MOST_FREQUENT = 24, 1_000_000
#: What reading one more posting of a list weighs against one subset, in the choice of the boundary.
SCAN_COST = 4.0
#: Members of an inverted list that one task compares at a time.
BLOCK = 512
#: A token that more members than this of one batch hold is first gathered within the batch.
CROWD = 256
#: Groups that crowds of one token fall into, at most.
SALTS = 4096
#: Sets that are compared with one copy of their hub's set.
STREAM = 2000
#: Passing pairs that a task holds before it hands them on.
HELD = 200_000
#: Largest filter of wanted sets, in bits.
MOST_BITS = 1 << 27


@dataclass(frozen=True)
class Rule:
    """Words are cut into runs of k; sets link when ``den * |A and B| >= num * |A or B|``."""

    k: int
    num: int
    den: int

    def least(self, n: np.ndarray | int) -> np.ndarray | int:
        """Shingles that a set of n shares with any set it links to, at least."""
        return -(-(n * self.num) // self.den)

    def largest(self, n: int) -> int:
        """Size of the largest set that one of n can link to."""
        return n * self.den // self.num


def _subset_sizes(rule: Rule, n: int) -> list[int]:
    """Sizes of the subsets that a light set of n enumerates: one for each size that the larger set of a link can have."""
    return sorted({int(rule.least(b)) for b in range(n, rule.largest(n) + 1) if rule.least(b) <= n})


def light_cost(rule: Rule, n: int) -> int:
    """Subsets that a light set of n enumerates."""
    total = 0
    for c in _subset_sizes(rule, n):
        ways = 1
        for i in range(n - c):
            ways = ways * (n - i) // (i + 1)
        total += ways
    return total


def boundary(rule: Rule, sizes: dict[int, int]) -> int:
    """Largest size of light sets: up to it, enumerating subsets costs no more than scanning the lists of prefixes would.

    Cost of a light set: its subsets. Cost of a heavy one: a posting, and SCAN_COST for the
    scan of its list, for every shingle of its prefix. ``sizes`` counts sets by size.
    """
    best, light, heavy = 0, 0.0, 0.0
    for n in range(1, 64):
        light += light_cost(rule, n) * sizes.get(n, 0)
        heavy += (n - rule.least(n) + 1) * (1 + SCAN_COST) * sizes.get(n, 0)
        if light <= heavy:
            best = n
        if light_cost(rule, n) > 2000:
            break
    return best


class _Recent:
    """Keys met lately, in a table of fixed size: a key that another one has pushed out counts as new again."""

    def __init__(self, slots: int = 1 << 16) -> None:
        self.slots = np.arange(slots, dtype=np.uint64) ^ np.uint64(1)  # a value that belongs elsewhere: empty

    def new(self, keys: np.ndarray) -> np.ndarray:
        keys = keys.view(np.uint64)
        at = (keys & np.uint64(len(self.slots) - 1)).astype(np.int64)
        fresh = np.zeros(len(keys), dtype=bool)
        fresh[np.unique(keys, return_index=True)[1]] = True
        fresh &= self.slots[at] != keys
        self.slots[at[fresh]] = keys[fresh]
        return fresh


def _sets(batch: pa.RecordBatch, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, rows, row of each shingle, distinct shingles, fingerprint of each row's set) of runs of texts."""
    for first, data, offsets in text_runs(batch["text"]):
        row, at, h = shingle_hashes(*word_hashes(data, offsets), k)
        row, h = distinct_sorted(row, h)
        rows = len(offsets) - 1
        n = np.bincount(row, minlength=rows)
        start = np.cumsum(n) - n
        sums = np.r_[np.uint64(0), np.cumsum(mix(h ^ np.uint64(0xA0761D6478BD642F)))]
        key = mix(sums[start + n] - sums[start] + n.astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB)).view(np.int64)
        yield first, rows, row, h, key


def _fingerprints(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, rows, row, h, key in _sets(batch, k):
                n = np.bincount(row, minlength=rows)
                bits = np.clip(1 << np.ceil(np.log2(np.maximum(2 * n, 2))).astype(np.int64), LEAST_BITS, MOST_SKETCH)
                start = np.cumsum(bits) - bits
                spot = start[row] + (mix(h + np.uint64(77)) & (bits[row] - 1).astype(np.uint64)).astype(np.int64)
                sketch = np.packbits((np.bincount(spot, minlength=int(bits.sum())) & 1).astype(np.uint8))
                held = pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer((np.r_[start, bits.sum()] // 8).astype(np.int32)), pa.py_buffer(sketch.tobytes())])
                part = batch.slice(first, rows)
                yield pa.RecordBatch.from_arrays([part["doc_id"], part["row"], pa.array(n), pa.array(key), held], ["doc_id", "row", "n", "key", "sketch"])

    return run


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Bits in which sketches differ, at most the shingles that one set has and the other has not.

    A bit is the parity of the shingles that fall on it, so halves of a larger sketch, combined
    by exclusive or, are the smaller sketch.
    """
    while x.shape[-1] > y.shape[-1]:
        x = x[..., : x.shape[-1] // 2] ^ x[..., x.shape[-1] // 2 :]
    while y.shape[-1] > x.shape[-1]:
        y = y[..., : y.shape[-1] // 2] ^ y[..., y.shape[-1] // 2 :]
    return np.bitwise_count(x ^ y).sum(axis=-1).astype(np.int64)


def _crowds(token: np.ndarray, key: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """Postings of a batch. Members of a crowded token form a group of their own; its smallest one goes to the token's list for all."""
    order = np.lexsort((key, token))
    token, key, n = token[order], key[order], n[order]
    first = np.flatnonzero(np.r_[True, token[1:] != token[:-1]]) if len(token) else np.zeros(0, np.int64)
    size = np.diff(np.r_[first, len(token)])
    crowd = np.repeat(size > CROWD, size)
    lead = first[size > CROWD]
    token, key, n = (np.r_[v, v[lead]] for v in (token, key, n))
    salt = int(mix(key.view(np.uint64)).sum() % np.uint64(SALTS)) + 1  # follows from the batch, so a task that runs again gives the same
    group = np.r_[np.where(crowd, salt, 0), np.zeros(len(lead), np.int64)].astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(group), pa.array(key), pa.array(n)], ["token", "salt", "key", "n"])


def _postings(rule: Rule, light: int, frequent: np.ndarray | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Tokens of every set that can link to another: subsets of light ones, prefixes of heavy ones.

    Sets over ``light`` and those that can link to one are indexed by prefix: the shingles
    that come first in an order common to all (frequent ones last, else by hash), as many
    as leave less than the least overlap. Without ``frequent``, the prefix in plain hash order.
    """

    def tokens(rows: int, row: np.ndarray, h: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = np.bincount(row, minlength=rows)
        start = np.cumsum(n) - n
        out = [(np.zeros(0, np.int64), np.zeros(0, np.uint64))]
        heavy = new & (np.array([rule.largest(int(v)) for v in n]) > light)
        pick = heavy[row]
        r, s = row[pick], h[pick]
        if len(r):
            if frequent is not None and len(frequent):
                last = frequent[np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)] == s
                order = np.lexsort((s, last, r))
                r, s = r[order], s[order]
            rank = np.arange(len(r)) - np.repeat(np.flatnonzero(np.r_[True, r[1:] != r[:-1]]), np.diff(np.r_[np.flatnonzero(np.r_[True, r[1:] != r[:-1]]), len(r)]))
            inside = rank < (n - rule.least(n) + 1)[r]
            out.append((r[inside], s[inside]))
        if frequent is not None:
            for i in np.flatnonzero(new & (n <= light)):
                own = h[start[i] : start[i] + n[i]]
                for c in _subset_sizes(rule, int(n[i])):
                    subsets = np.array(list(itertools.combinations(own, c)), dtype=np.uint64)
                    found = mix(mix(subsets).sum(axis=1, dtype=np.uint64) + np.uint64(c))
                    out.append((np.full(len(found), i), found))
        r, s = (np.concatenate(x) for x in zip(*out, strict=True))
        return r, s

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent = _Recent()
        for batch in batches:
            found = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
            for _, rows, row, h, key in _sets(batch, rule.k):
                n = np.bincount(row, minlength=rows)
                r, s = tokens(rows, row, h, recent.new(key) & (n > 0))  # copies in a task are indexed once
                found.append((s, key[r], n[r]))
            token, key, n = (np.concatenate(x) for x in zip(*found, strict=True))
            if frequent is None:
                yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64))], ["token"])
            else:
                yield _crowds(token, key, n)

    return run


def _wanted_bits(keys: DataFrame) -> np.ndarray:
    """A Bloom filter of 64-bit ``key``s with 16 bits each, up to MOST_BITS in all."""
    count = keys.count()
    bits = min(MOST_BITS, 1 << max(16, (16 * count).bit_length()))
    spots = F.array(*[F.shiftrightunsigned("key", s).bitwiseAND(F.lit(bits - 1)) for s in (0, 17, 34)])
    words = keys.select(F.explode(spots).alias("bit")).groupBy(F.shiftright("bit", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(bit & 63 AS int)))").alias("mask")).toArrow()
    out = np.zeros(bits // 64, dtype=np.uint64)
    out[words["word"].to_numpy()] = words["mask"].to_numpy().view(np.uint64)
    return out


def _wanted_sets(k: int, wanted: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent = _Recent()
        mask = np.uint64(len(wanted) * 64 - 1)
        for batch in batches:
            for _, rows, row, h, key in _sets(batch, k):
                maybe = recent.new(key)
                for s in (0, 17, 34):
                    bit = (key.view(np.uint64) >> np.uint64(s)) & mask
                    maybe &= (wanted[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
                n = np.bincount(row, minlength=rows)
                start = np.cumsum(n) - n
                pick = np.flatnonzero(maybe & (n > 0))
                found = [h[start[i] : start[i] + n[i]].tobytes() for i in pick]
                yield pa.RecordBatch.from_arrays([pa.array(key[pick]), pa.array(found, pa.binary())], ["key", "shingles"])

    return run


def _linked(rule: Rule) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Which sets link with their hub's: rows ``b, salt, a, shingles``, the hub's own set (``a`` null) first in its group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, of = np.zeros(0, np.uint64), None
        for batch in batches:
            a, b, good = batch["a"], batch["b"].to_numpy(), np.zeros(batch.num_rows, dtype=bool)
            own = a.is_null().to_numpy(zero_copy_only=False)
            for i, value in enumerate(batch["shingles"]):
                x = np.frombuffer(value.as_buffer(), dtype=np.uint64)
                if own[i]:
                    hub, of = x.copy(), b[i]
                    continue
                assert of == b[i]
                both = int((hub[np.minimum(np.searchsorted(hub, x), len(hub) - 1)] == x).sum())
                good[i] = rule.den * both >= rule.num * (len(x) + len(hub) - both)
            yield pa.RecordBatch.from_arrays([a.filter(pa.array(good)), batch["b"].filter(pa.array(good))], ["a", "b"])

    return run


def _verify(texts: DataFrame, rule: Rule, pairs: DataFrame) -> DataFrame:
    """The ``pairs`` (a, b) of sets that link, by their whole sets, written.

    Pairs are grouped by b, the hub. Its set goes once to each group of at most about STREAM
    pairs, so a hub of very many pairs is spread; the other sets stream past it.
    """
    spark = texts.sparkSession
    ends = keep(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct(), "ends")
    bits = spark.sparkContext.broadcast(_wanted_bits(ends))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _wanted_sets(rule.k, bits.value)(batches)

    found = texts.mapInArrow(sets, "key long, shingles binary").join(ends, "key", "left_semi").groupBy("key").agg(F.first("shingles").alias("shingles"))
    found = keep(found, "sets")
    hubs = pairs.groupBy("b").agg(F.ceil(F.count("*") / STREAM).cast("int").alias("parts"))
    crowded = hubs.where("parts > 1")
    asked = pairs.join(crowded, "b", "left").select("b", F.coalesce(F.pmod(F.xxhash64("a"), F.col("parts")), F.lit(0)).cast("int").alias("salt"), "a")
    asked = asked.join(found.withColumnRenamed("key", "a"), "a")
    own = hubs.select("b", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt")).join(found.withColumnRenamed("key", "b"), "b").withColumn("a", F.lit(None).cast("long"))
    rows = asked.select("b", "salt", "a", "shingles").unionByName(own.select("b", "salt", "a", "shingles"))
    rows = rows.repartition("b", "salt").sortWithinPartitions("b", "salt", F.asc_nulls_first("a"))
    out = keep(rows.mapInArrow(_linked(rule), "a long, b long"), "linked")
    bits.unpersist()
    release(ends, found)
    return out


def _close(rule: Rule) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pairs that pass a test that every link passes, from sizes and sketches ``x`` and ``y``.

    Sketches differ in at most |A xor B| bits, and a link has
    (den + num) * |A xor B| <= (den - num) * (|A| + |B|).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch["x"], batch["y"], strict=True)
            apart = np.array([int(_apart(*(np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in p))) for p in pairs], dtype=np.int64)
            good = pa.array((rule.den + rule.num) * apart <= (rule.den - rule.num) * (batch["n"].to_numpy() + batch["hub_n"].to_numpy()))
            yield pa.RecordBatch.from_arrays([batch["a"].filter(good), batch["b"].filter(good)], ["a", "b"])

    return run


def _forest(x: np.ndarray, y: np.ndarray, apart: np.ndarray, group: np.ndarray, root: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Indexes of the pairs, closest first, that each join two roots of a group not joined before."""
    parent: dict[tuple[int, int], tuple[int, int]] = {}

    def top(g: tuple[int, int]) -> tuple[int, int]:
        while (up := parent.get(g, g)) != g:
            parent[g] = parent.get(up, up)
            g = up
        return g

    out = []
    for p in np.lexsort((np.minimum(key[x], key[y]), np.maximum(key[x], key[y]), apart)).tolist():
        a, b = top((int(group[p]), int(root[x[p]]))), top((int(group[p]), int(root[y[p]])))
        if a != b:
            parent[a] = b
            out.append(p)
    return np.array(out, dtype=np.int64)


def _pairs_within(at: np.ndarray, rows: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of one group, for all groups side by side: neighbours at distance 1, 2, ... as far as groups reach."""
    end = np.repeat(at[1:], np.diff(at))
    x = np.arange(rows)
    d = 1
    while len(x := x[x + d < end[x]]):
        yield x, x + d
        d += 1


def _refuted(table: pa.Table) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Whether pairs (row, smaller key) are in the rows' lists ``no``, which are held as one sorted array."""
    column = table["no"].combine_chunks() if isinstance(table["no"], pa.ChunkedArray) else table["no"]
    count = column.value_lengths().fill_null(0).to_numpy()
    flat = column.flatten().to_numpy().view(np.uint64)

    def mark(row: np.ndarray, key: np.ndarray) -> np.ndarray:
        return mix(key.view(np.uint64) ^ mix(row.astype(np.uint64)))

    held = np.sort(mark(np.repeat(np.arange(len(count)), count), flat))

    def test(row: np.ndarray, key: np.ndarray) -> np.ndarray:
        if not len(held):
            return np.zeros(len(row), dtype=bool)
        m = mark(row, key)
        return held[np.minimum(np.searchsorted(held, m), len(held) - 1)] == m

    return test


def _compare(rule: Rule, closest: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For every two blocks of members, pairs across components that pass the bounds and were not refuted: all, or the ``closest`` ones that would join all they can.

    Passing pairs are handed on as they are found; of closest ones only those that join two
    roots are held, as joining the rest later gives the same forest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, at in whole_groups(batches, ["token", "i", "j"], 8_000):
            key, n, root, block, i, j, token = (table[c].to_numpy() for c in ("key", "n", "root", "block", "i", "j", "token"))
            refuted = _refuted(table)
            column = table["sketch"].combine_chunks() if isinstance(table["sketch"], pa.ChunkedArray) else table["sketch"]
            sketches = [np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in column]
            wide = np.array([len(v) for v in sketches])
            place = np.zeros(len(wide), dtype=np.int64)
            stacks = {}
            for w in np.unique(wide).tolist():
                m = np.flatnonzero(wide == w)
                place[m] = np.arange(len(m))
                stacks[w] = np.stack([sketches[v] for v in m])
            held = [np.zeros(0, np.int64)] * 3

            def told(x: np.ndarray, y: np.ndarray, token: np.ndarray = token, key: np.ndarray = key) -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([pa.array(token[x]), pa.array(np.maximum(key[x], key[y])), pa.array(np.minimum(key[x], key[y]))], ["token", "a", "b"])

            def joined(held: list[np.ndarray], at: np.ndarray = at, root: np.ndarray = root, key: np.ndarray = key) -> list[np.ndarray]:
                x, y, d = held
                pick = _forest(x, y, d, np.searchsorted(at, x, side="right"), root, key)
                return [x[pick], y[pick], d[pick]]

            for x, y in _pairs_within(at, len(key)):
                pick = (root[x] != root[y]) & (key[x] != key[y]) & ((i[x] == j[x]) | (block[x] != block[y])) & (rule.den * np.minimum(n[x], n[y]) >= rule.num * np.maximum(n[x], n[y]))
                x, y = x[pick], y[pick]
                for w, v in {(int(w), int(v)) for w, v in zip(wide[x], wide[y], strict=True)}:
                    own = np.flatnonzero((wide[x] == w) & (wide[y] == v))
                    for part in np.array_split(own, -(-len(own) * max(w, v) // 1_000_000)):
                        u, t = x[part], y[part]
                        d = _apart(stacks[w][place[u]], stacks[v][place[t]])
                        fine = (rule.den + rule.num) * d <= (rule.den - rule.num) * (n[u] + n[t])
                        u, t, d = u[fine], t[fine], d[fine]
                        fine = ~refuted(np.where(key[u] > key[t], u, t), np.minimum(key[u], key[t]))
                        held = [np.concatenate(p) for p in zip(held, (u[fine], t[fine], d[fine]), strict=True)]
                if len(held[0]) > HELD:
                    if closest:
                        held = joined(held)
                    else:
                        yield told(*held[:2])
                        held = [np.zeros(0, np.int64)] * 3
            if len(held[0]):
                yield told(*(joined(held) if closest else held)[:2])

    return run


def jaccard_components(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5, id: str = "doc_id", text: str = "text", row: Column | None = None) -> DataFrame:
    """Groups of documents that links reach: ``doc_id, n_shingles, component_id`` for every row.

    A document's set holds the distinct runs of ``k`` words (ASCII lower case, ASCII white
    space) of its whole text; a text of fewer words has all of them as one run, a text
    without words has none and links with nothing. Documents link when
    ``den * |A and B| >= num * |A or B|``; ``component_id`` is the smallest id reached.

    1. Equal sets form a class (64-bit fingerprint); one member stands for it, so copies
       never meet in pairs.
    2. Light sets, up to a size chosen by cost from the counts of all sizes, enumerate
       their subsets of fixed sizes; a pair links only if it shares one. Heavy sets are
       found through inverted lists of their prefixes.
    3. In each list, every member is paired with the list's smallest member only. Of a token
       that a batch of texts holds often, the batch's members are paired with their own smallest
       one, and that one alone goes to the list for all, so a token that a third of all texts
       hold has a list of batches, not of texts. Pairs that pass exact bounds (sizes, parity
       sketches) are verified on whole sets, and links are joined into components.
    4. Lists whose members now lie in one component are done: nothing in them can change the
       result. In the others, members outside the list's largest component are compared by the
       exact bounds with all members of other components, in blocks of 512 by 512; a
       list of which nearly all is joined is read about twice. Of the pairs that pass, the
       closest that would join all members of two blocks are verified first, less than they have
       members; then, in lists that had any, all pairs that still pass and lie across
       components, until there are none. So no link between different texts is missed, whatever
       the length of a list.

    With ``row``, a 64-bit key of the rows, it comes back as a column, and ``root`` with it: the same
    for all rows of a group, whatever their ids, and null for rows without words.

    Sets are recomputed from the texts where they are needed rather than moved about. A null
    text is empty; repeated rows are kept; a null id is ignored in the smallest id; other
    columns are ignored; an empty table gives no rows.
    """
    spark: SparkSession = docs.sparkSession
    importable(spark)
    rule = Rule(k, num, den)
    texts = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), (F.lit(None) if row is None else row).cast("long").alias("row"))
    prints = keep(texts.mapInArrow(_fingerprints(k), "doc_id long, row long, n long, key long, sketch binary"), "prints")
    classes = keep(prints.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("least_id"), F.first("n").alias("n"), F.first("sketch").alias("sketch")), "classes")
    sizes = {r["n"]: r["count"] for r in classes.where("n < 64").groupBy("n").count().collect()}
    light = boundary(rule, sizes)
    only = texts.select("text")
    counted = keep(only.mapInArrow(_postings(rule, light, None), "token long").groupBy("token").count().where(F.col("count") > FREQUENT), "counted")
    steps = sorted(counted.groupBy(F.floor(F.log2("count")).cast("int").alias("step")).agg(F.count("*").alias("tokens")).collect(), reverse=True)
    fit = [r["step"] for r, upto in zip(steps, itertools.accumulate(r["tokens"] for r in steps), strict=True) if upto <= MOST_FREQUENT]
    often = counted.where(F.log2("count") >= (min(fit) if fit else 64)).select("token").toArrow()["token"].to_numpy()
    release(counted)
    frequent = spark.sparkContext.broadcast(np.sort(often.view(np.uint64)) if len(often) else np.zeros(0, np.uint64))

    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _postings(rule, light, frequent.value)(batches)

    in_list = Window.partitionBy("token", "salt").orderBy("key")
    lists = only.mapInArrow(postings, "token long, salt int, key long, n long").withColumn("hub", F.first("key").over(in_list)).withColumn("hub_n", F.first("n").over(in_list))
    members = keep(lists.where("hub <> key").drop("salt"), "lists")
    sketches = classes.select("key", "sketch")
    stars = members.where(f"{den} * least(n, hub_n) >= {num} * greatest(n, hub_n)").select(F.col("key").alias("a"), F.col("hub").alias("b")).distinct()
    x = classes.select(F.col("key").alias("a"), "n", F.col("sketch").alias("x"))
    y = classes.select(F.col("key").alias("b"), F.col("n").alias("hub_n"), F.col("sketch").alias("y"))
    close = keep(stars.join(x, "a").join(y, "b").mapInArrow(_close(rule), "a long, b long"), "close")
    links = _verify(only, rule, close)
    groups = keep(connected_components(links), "groups")

    rows = keep(members.select("token", "key", "n").unionByName(members.select("token", F.col("hub").alias("key"), F.col("hub_n").alias("n"))).distinct(), "members")
    release(members)
    refuted, closest = keep(close.join(links, ["a", "b"], "left_anti"), "refuted"), True
    release(close)
    while True:
        rooted = rows.join(groups.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
        shares = rooted.groupBy("token", "root").agg(F.count("*").alias("size"))
        split = shares.groupBy("token").agg(F.max_by("root", F.struct("size", "root")).alias("most"), F.max("size").alias("inside"), F.sum("size").alias("size"), F.count("*").alias("roots")).where("roots > 1")
        split = split.select("token", "most", F.ceil((F.col("size") - F.col("inside")) / BLOCK).cast("int").alias("outer"), F.ceil(F.col("inside") / BLOCK).cast("int").alias("inner"))
        open_ = keep(rooted.join(split, "token"), "open")
        # Outsiders lie in blocks before those of the largest component, whose members meet outsiders only.
        outside, mixed = F.col("root") != F.col("most"), F.xxhash64("key")
        block = F.when(outside, F.pmod(mixed, F.col("outer"))).otherwise(F.col("outer") + F.pmod(mixed, F.col("inner"))).cast("int")
        last = F.when(outside, F.col("outer") + F.col("inner")).otherwise(F.col("outer")) - 1
        no = refuted.groupBy(F.col("a").alias("key")).agg(F.collect_set("b").alias("no"))
        parts = open_.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), last))).join(sketches, "key").join(no, "key", "left")
        parts = parts.select("token", "key", "n", "root", "block", "sketch", "no", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
        order = ["token", "i", "j"]
        candidates = keep(parts.repartition(*order).sortWithinPartitions(*order).mapInArrow(_compare(rule, closest), "token long, a long, b long"), "candidates")
        if candidates.isEmpty():
            break
        more = candidates.select("a", "b").distinct()
        good = _verify(only, rule, more)
        past = [refuted, links, groups, good, rows, open_, candidates]
        refuted = keep(refuted.unionByName(more.join(good, ["a", "b"], "left_anti")), "refuted")
        links = keep(links.unionByName(good), "links")
        groups = keep(connected_components(links), "groups")
        # A list without a candidate now has none later: bounds don't change, and components only grow.
        rows, closest = keep(open_.select("token", "key", "n").join(candidates.select("token").distinct(), "token", "left_semi"), "members"), False
        release(*past)
    release(refuted, links, rows, open_, candidates)

    named = classes.select("key", "least_id").join(groups.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    smallest = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    of_class = named.join(smallest, "root").select("key", "component_id", "root")
    out = prints.select("doc_id", "row", "n", "key").join(of_class, "key", "left")
    own = ["row", "root"] if row is not None else []
    # Written, so its joins are :func:`keep`'s too, and nothing is left of what it is made of.
    done = keep(out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), *own), "components")
    release(prints, classes, groups)
    return done
