"""Near-duplicate texts by SuperMinHash signatures, banding, exact verification and component grouping.

Method, on the set of distinct 5-word shingles of each whole text:

1. SuperMinHash (Ertl): every element draws a random permutation of the m registers and the ranks 0..m-1 along it,
   each with a random fraction; a register keeps the least value. The ranks of an element are all different, which
   gives the lower variance. Step j only concerns registers still above j, so a text stops once none is.
2. Texts with equal sets become one numbered class, so copies are never paired; a row of its smallest id stands for it.
3. Banding: 25 bands of 5 registers. A pair at similarity 0.85 shares no band with a probability of 5e-7.
4. Each class of a bucket is paired with the bucket's smallest class only; pairs go on if their sizes allow the
   threshold and if enough of 128 four-bit registers agree (six standard deviations below what is due). The rest is
   confirmed on the full sets, and components are formed.
5. In buckets that still hold several components all pairs across components are looked at, in blocks, but those inside
   the bucket's largest component are not. A task gives back only a forest of the pairs that are possible, so rows stay
   linear in the members. The forest's components are clusters, in which every pair that is still open lies.
6. In each cluster, again in blocks, the pairs across components that are possible are decided on the full sets, and a
   forest of the links is given back. After that every candidate pair is either confirmed, refuted or inside one
   component: no link between different texts is lost, and no group's pairs are ever listed.

Components come from distributed rounds (``components``), not from the driver.

Cases: a null or blank text has an empty set, links with nothing and is its own component. With fewer than five words
the whole sequence is the one shingle. Repeated rows of an id share its class. A null id cannot be named: such rows
come back with a null component unless another row has their set. Very long texts are worked on one at a time. An empty table gives an empty result. Only
the named id and text columns are read, so other columns can have any name.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import attach, drop, saved, staying
from .components import connected_components, smallest_ids
from .memory import lean
from .shingles import distinct, mix, runs, shingle_hashes, shingle_sets

REGISTERS, BANDS, ROWS = 128, 25, 5
PLANES = [f"p{i}" for i in range(8)]


def super_minhash(elements: np.ndarray, counts: np.ndarray, m: int = REGISTERS) -> np.ndarray:
    """SuperMinHash signatures (texts x m, unsigned 32-bit) of the element hashes of several texts; no elements: all ones.

    A register's value is its rank and a fraction of 2^24, so values of different ranks never meet.
    """
    n = len(counts)
    least = np.full(n * m, np.iinfo(np.uint32).max, np.uint32)
    owner = np.repeat(np.arange(n), counts)
    seeds, permutation = elements, None
    for j in range(m):
        draw = mix(seeds + np.uint64(((j + 1) * 0x9E3779B97F4A7C15) % 2**64))
        k = j + ((draw >> np.uint64(32)) * np.uint64(m - j) >> np.uint64(32)).astype(np.int64)
        value = (np.uint32(j) << np.uint32(24)) | (draw & np.uint64(0xFFFFFF)).astype(np.uint32)
        if permutation is None:
            register, first = k, k
        else:
            if j == 1:  # the first step's exchange, made good now that a permutation is kept
                line = np.arange(len(first))
                permutation[line, first] = 0
                permutation[:, 0] = first
            line = np.arange(len(seeds))
            register = permutation[line, k].astype(np.int64)
            permutation[line, k] = permutation[:, j]
            permutation[:, j] = register
        np.minimum.at(least, owner * m + register, value)
        # texts with a register above the next rank go on
        going = (least.reshape(n, m).max(axis=1) >> np.uint32(24)) > j
        keep = going[owner]
        if not keep.any():
            break
        seeds, owner = seeds[keep], owner[keep]
        if permutation is None:
            first = first[keep]
            permutation = np.broadcast_to(np.arange(m, dtype=np.uint8), (len(seeds), m)).copy()
        else:
            permutation = permutation[keep]
    return least.reshape(n, m)


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """(texts x BANDS) 64-bit keys; a band's number is part of its key."""
    key = np.broadcast_to(mix(np.arange(1, BANDS + 1, dtype=np.uint64)), (len(signatures), BANDS)).copy()
    for r in range(ROWS):
        key = mix(key + signatures[:, r : BANDS * ROWS : ROWS].astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))
    return key.view(np.int64)


def bit_planes(signatures: np.ndarray) -> np.ndarray:
    """(texts x 8) longs: bit b of every register's hash for b = 0..3, in two halves of 64 registers."""
    low = mix(signatures.astype(np.uint64))
    out = np.empty((len(signatures), 8), np.int64)
    for b in range(4):
        bits = ((low >> np.uint64(b)) & np.uint64(1)).astype(np.uint8)
        out[:, 2 * b : 2 * b + 2] = np.packbits(bits, axis=1).view(np.int64)
    return out


def _signed(batches):
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        for row, rows, data, offsets in runs(texts):
            hashes, counts = shingle_hashes(data, offsets)
            ends = np.cumsum(counts)
            sets = [distinct(hashes[e - c : e]) for e, c in zip(ends, counts, strict=True)]
            sizes = np.array([len(s) for s in sets], np.int64)
            elements = np.concatenate(sets)
            signatures = super_minhash(elements, sizes)
            first = np.array([int(s.sum(dtype=np.uint64)) for s in sets], np.uint64)
            second = np.array([int(mix(s).sum(dtype=np.uint64)) for s in sets], np.uint64)
            bands = band_keys(signatures)
            planes = bit_planes(signatures)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(row, rows),
                    batch.column(2).slice(row, rows),
                    pa.array(sizes),
                    pa.array(first.view(np.int64)),
                    pa.array(second.view(np.int64)),
                    pa.ListArray.from_arrays(np.arange(rows + 1, dtype=np.int32) * BANDS, pa.array(bands.ravel())),
                    *[pa.array(planes[:, i].copy()) for i in range(8)],
                ],
                names=["id", "t", "n", "d0", "d1", "bands", *PLANES],
            )


def _sets(batches):
    for batch in batches:
        sets = [s.tobytes() for _, s in shingle_sets(batch.column(1))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["cls", "elements"])


def _confirmed(least_pct: int):
    def confirm(batches):
        for batch in batches:
            good = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                good[i] = 100 * both >= least_pct * (len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(good))

    return confirm


def _possible(x: str, y: str, least_pct: int) -> Column:
    """Sizes that allow the threshold, and enough equal four-bit registers: six standard deviations below the mean due."""
    least = _least_equal(least_pct)
    sizes = 100 * F.least(f"{x}.n", f"{y}.n") >= least_pct * F.greatest(f"{x}.n", f"{y}.n")
    half = lambda h: f"bit_count(~({' | '.join(f'({x}.p{2 * b + h} ^ {y}.p{2 * b + h})' for b in range(4))}))"
    return sizes & (F.expr(f"{half(0)} + {half(1)}") >= least)


#: A block holds at most about so many members, and elements.
BLOCK_ROWS, BLOCK_ELEMENTS = 1024, 2_000_000
#: Pairs in a bucket of at most so many members are listed by a join; larger ones are worked on in blocks.
SMALL_BUCKET = 24


def _across(rows: DataFrame, key: str, task, schema: str, columns: list[str], beyond: int = 1, more: DataFrame | None = None) -> DataFrame:
    """Runs ``task`` on blocks of each key with several components and more than ``beyond`` members: (members outside the
    largest component) x (all). ``more`` adds columns by class. Blocks are dealt by key and place, so that those of one key
    run in as many tasks as there are; a hot key's sizes reach its members by a broadcast (see ``attach``).
    """
    parts = rows.groupBy(key, "comp").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("sum"))
    whole = parts.groupBy(key).agg(
        F.count(F.lit(1)).alias("comps"), F.max(F.struct("size", "comp")).alias("top"), F.sum("size").alias("size"), F.sum("sum").alias("sum")
    )
    blocks = lambda size: F.greatest(F.ceil(size / BLOCK_ROWS), F.ceil(F.col("sum") / F.col("size") * size / BLOCK_ELEMENTS), F.lit(1)).cast("int")
    whole = whole.filter((F.col("comps") > 1) & (F.col("size") > beyond)).select(
        key, "size", F.col("top.comp").alias("largest"), blocks(F.col("size")).alias("right"), blocks(F.col("size") - F.col("top.size")).alias("left")
    )
    whole = saved(whole, "open-keys")
    placed = attach(rows, whole, key, "size", rows.count()).filter("largest is not null").withColumn("h", F.xxhash64("cls"))
    placed = placed if more is None else placed.join(more, "cls")
    other = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = placed.filter("comp != largest").select(key, F.expr("cast(pmod(h, left) as int)").alias("i"), other("right").alias("j"), F.lit(True).alias("is_left"), *columns)
    right = placed.select(key, other("left").alias("i"), F.expr("cast(pmod(h, right) as int)").alias("j"), F.lit(False).alias("is_left"), *columns)
    return left.unionByName(right).repartition(key, "i", "j").groupBy(key, "i", "j").applyInPandas(task, schema)


class _Union:
    """Groups of numbered things, with the group of each at hand as an array."""

    def __init__(self, n: int):
        self.parent, self.label = list(range(n)), np.arange(n)

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.parent[max(i, j)] = min(i, j)
        return i != j

    def relabel(self) -> None:
        label = np.array(self.parent)
        while not np.array_equal(label, up := label[label]):
            label = up
        self.label = label


def _least_equal(least_pct: int) -> int:
    same = 15 / 16 * least_pct / 100 + 1 / 16
    return int(REGISTERS * same - 6 * (REGISTERS * same * (1 - same)) ** 0.5)


def _open_pairs(pdf: pd.DataFrame, least_pct: int, groups: np.ndarray, union: _Union):
    """(left row, right rows) of a block: possible pairs of different groups that are not joined when they are asked for."""
    side = pdf["is_left"].to_numpy(bool)
    left, right = np.flatnonzero(side), np.flatnonzero(~side)
    planes = np.ascontiguousarray(pdf[PLANES].to_numpy(np.int64)).view(np.uint64)
    n, least = pdf["n"].to_numpy(np.int64), _least_equal(least_pct)
    for i in left.tolist():
        equal = np.zeros(len(right), np.int64)
        for half in (0, 1):
            apart = np.zeros(len(right), np.uint64)
            for b in range(4):
                apart |= planes[right, 2 * b + half] ^ planes[i, 2 * b + half]
            equal += np.bitwise_count(~apart)
        good = (equal >= least) & (100 * np.minimum(n[i], n[right]) >= least_pct * np.maximum(n[i], n[right]))
        good &= union.label[groups[i]] != union.label[groups[right]]
        if good.any():
            yield i, right[good]


def _forest(least_pct: int):
    """Joins components by pairs that are possible; gives the joins (a, b), as components."""

    def task(pdf: pd.DataFrame) -> pd.DataFrame:
        comps, groups = np.unique(pdf["comp"].to_numpy(np.int64), return_inverse=True)
        union, out = _Union(len(comps)), []
        for i, rows in _open_pairs(pdf, least_pct, groups, union):
            found = [(int(groups[i]), int(g)) for g in np.unique(groups[rows]) if union.join(int(groups[i]), int(g))]
            if found:
                out += found
                union.relabel()
        return pd.DataFrame([(comps[x], comps[y]) for x, y in out], columns=["a", "b"], dtype=np.int64)

    return task


def _decided(least_pct: int):
    """Joins components by pairs whose full sets link; gives the links (a, b), as classes."""

    def task(pdf: pd.DataFrame) -> pd.DataFrame:
        comps, groups = np.unique(pdf["comp"].to_numpy(np.int64), return_inverse=True)
        cls, n = pdf["cls"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64)
        elements = [np.frombuffer(e, np.uint64) for e in pdf["elements"]]
        union, out = _Union(len(comps)), []
        for i, rows in _open_pairs(pdf, least_pct, groups, union):
            # the elements of all candidates at once: which of them does i hold?
            flat = np.concatenate([elements[k] for k in rows])
            at = np.minimum(np.searchsorted(elements[i], flat), n[i] - 1)
            both = np.add.reduceat(elements[i][at] == flat, np.cumsum(n[rows]) - n[rows], dtype=np.int64)
            linked = rows[100 * both >= least_pct * (n[i] + n[rows] - both)]
            found = [(int(cls[i]), int(cls[k])) for k in linked.tolist() if union.join(int(groups[i]), int(groups[k]))]
            if found:
                out += found
                union.relabel()
        return pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)

    return task


def near_groups(docs: DataFrame, least_pct: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per row of ``docs``: id_col, n_shingles, component_id, kept.

    Linked are texts whose sets overlap by at least ``least_pct`` per cent of their union; ``component_id`` is the smallest
    id that links reach and ``kept`` marks the rows with that id.
    """
    return _near_rows(docs, least_pct, id_col, text_col).drop("_qm_t")


def _text_digest(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def _near_rows(docs: DataFrame, least_pct: int, id_col: str, text_col: str) -> DataFrame:
    """``near_groups`` with ``_qm_t``, the digest of the row's text."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), _text_digest(F.col(text_col)).alias("t"))
    schema = "id long, t binary, n long, d0 long, d1 long, bands array<long>, " + ", ".join(f"{p} long" for p in PLANES)
    signed = saved(texts.mapInArrow(lean(_signed), schema), "signed")

    # classes of equal sets; equal sets have equal signatures, so any member's will do
    classes = signed.filter("n > 0 and id is not null").groupBy("d0", "d1").agg(
        F.min(F.struct("id", "t")).alias("own"), F.count(F.lit(1)).alias("copies"), *[F.first(c).alias(c) for c in ("n", *PLANES, "bands")]
    )
    # an id may occur with several texts, so it cannot name a class
    classes = classes.withColumn("least", F.col("own.id")).withColumn("cls", F.monotonically_increasing_id())
    classes = saved(classes, "classes")
    entries = classes.select("cls", "n", *PLANES, F.explode("bands").alias("bucket"))
    shared = classes.select("cls", F.explode("bands").alias("bucket")).groupBy("bucket").agg(
        F.min("cls").alias("rep"), F.count(F.lit(1)).alias("members")
    ).filter("members > 1").drop("members")
    members = saved(entries.join(shared, "bucket").select("bucket", "rep", F.struct("cls", "n", *PLANES).alias("m")), "buckets")

    reps = members.filter("m.cls = rep").select("bucket", F.col("m").alias("r"))
    stars = (
        members.filter("m.cls != rep").join(reps, "bucket").filter(_possible("m", "r", least_pct))
        .select(F.col("r.cls").alias("a"), F.col("m.cls").alias("b")).distinct()
    )
    stars = saved(stars, "stars")
    sets = _sets_of(texts, classes, stars.select("a").union(stars.select("b")))
    links = saved(_verified(stars, sets, least_pct), "links")
    found = saved(connected_components(links), "components")

    # what the stars left open: buckets with several components; a forest of the pairs that are possible across them
    placed = members.join(found, F.col("m.cls") == F.col("node"), "left").select(
        "bucket", F.coalesce("component", F.col("m.cls")).alias("comp"), "m.*"
    )
    placed = saved(placed, "placed")
    forest = _across(placed, "bucket", _forest(least_pct), "a long, b long", ["cls", "comp", "n", *PLANES], SMALL_BUCKET)
    # a small bucket's pairs are bounded by its size, so a join may list them
    small = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    small = small.filter((F.col("lo") < F.col("hi")) & (F.col("size") <= SMALL_BUCKET)).select("bucket")
    few = placed.join(small, "bucket").select("bucket", "comp", F.struct("n", *PLANES).alias("m"))
    l, r = few.withColumnsRenamed({"m": "l", "comp": "a"}), few.withColumnsRenamed({"m": "r", "comp": "b"})
    few = l.join(r, "bucket").filter((F.col("a") < F.col("b")) & _possible("l", "r", least_pct)).select("a", "b")
    clusters = connected_components(saved(forest.unionByName(few).distinct(), "forest"))
    clusters = saved(clusters.select(F.col("node").alias("comp"), F.col("component").alias("cluster")), "clusters")
    if not clusters.isEmpty():
        # every pair that is still open lies in one cluster, where the full sets decide
        inside = classes.select("cls", "n", *PLANES).join(found, F.col("cls") == F.col("node"), "left")
        inside = inside.select("cls", "n", *PLANES, F.coalesce("component", "cls").alias("comp")).join(clusters, "comp")
        inside = saved(inside, "open")
        more = _sets_of(texts, classes, inside.select("cls"))
        last = _across(inside, "cluster", _decided(least_pct), "a long, b long", ["cls", "comp", "n", *PLANES, "elements"], more=more)
        all_links = saved(links.unionByName(last), "links")
        drop(found, inside, more)
        found = saved(connected_components(all_links), "components")
        drop(all_links)
    drop(members, placed, sets, stars, links, clusters)

    groups = classes.select("d0", "d1", "cls", "least", "copies").join(smallest_ids(classes, found), "cls", "left")
    groups = saved(groups.select(F.struct("d0", "d1").alias("d"), "copies", F.coalesce("component_id", "least").alias("component_id")), "groups")
    drop(classes, found)
    rows = signed.select("id", "t", "n", F.struct("d0", "d1").alias("d"))
    grouped = attach(rows, groups, "d", "copies", signed.count())
    return grouped.select(
        F.col("id").alias(id_col),
        F.col("t").alias("_qm_t"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.coalesce("component_id", "id")).otherwise(F.col("id")).alias("component_id"),
    ).withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))


def _sets_of(texts: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cls, elements): the full sets of the classes in the one column of ``wanted``; one row a class."""
    wanted = saved(classes.join(wanted.toDF("cls").distinct(), "cls").select("cls", "own.id", "own.t"), "wanted")
    # ids alone are narrow enough to broadcast: only the texts of wanted ids travel
    ids = saved(wanted.select("id").distinct(), "ids")
    rows = texts.join(ids, "id", "left_semi").join(wanted, ["id", "t"]).select("cls", "text").mapInArrow(lean(_sets), "cls long, elements binary")
    out = saved(rows.groupBy("cls").agg(F.first("elements").alias("elements")), "sets")
    drop(wanted, ids)
    return out


def _verified(pairs: DataFrame, sets: DataFrame, least_pct: int) -> DataFrame:
    x = sets.select(F.col("cls").alias("a"), F.col("elements").alias("x"))
    y = sets.select(F.col("cls").alias("b"), F.col("elements").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(_confirmed(least_pct), "a long, b long")


def dedup_near(docs: DataFrame, least_pct: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of every group of near duplicates the one with the smallest id; rows without id stay.

    Rows go by id and text: another text of the same id is not concerned.
    """
    out = _near_rows(docs, least_pct, id_col, text_col)
    decided = out.select(F.col(id_col).alias("id"), F.col("_qm_t").alias("digest"), "kept")
    return staying(docs, decided, id_col, _text_digest(F.col(text_col)))


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"), 85)
