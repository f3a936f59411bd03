"""From band keys to verified links and components, without pairs within a group.

`id` may be any orderable column (a long, or a struct). In a bucket (the ids of one band key) every member is compared
with one leader, the member that meets most others over all its buckets: with near copies, that is the text they come
from. The links give components. Members of a bucket that are of different components even so are compared too, if exact
bounds and their sketches let them be similar; sketches=False keeps to the exact bounds, and then no pair is lost that a
bucket holds. Groups of like texts, which form one component at once, are never expanded into pairs, and hot keys are
dealt over tasks in every join.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import HOT_KEYS, HOT_ROWS, hot_join, release, write_table
from .signatures import bag_minhash, minhash, minhash_bits

#: Bits of a sketch, one for each place of a signature: they differ with probability (1 - similarity) / 2.
BITS = 1024
#: A pair of similarity `least` differs by more standard deviations with probability 0.0002.
DEVIATIONS = 3.5
#: Members of a mixed bucket that one task compares with as many others.
BLOCK = 512
#: Parts of the space of keys that are looked at for hot ones.
PARTS = 1 << 16


def shared_rows(keys: DataFrame, *rows: DataFrame) -> list[DataFrame]:
    """Tables of all rows of whose key (a 64-bit hash) there are several, with n, how many; no key is in two of `rows`, and
    keys has the keys of all, as its only column.

    Rows are dealt by key once, those of one DataFrame after those of another, and each key is counted where its rows lie.
    Keys in parts of the key space (PARTS of them) with over 1/HOT_KEYS of all rows are counted before and joined instead,
    so that a hot key is dealt over tasks.
    """
    part = F.pmod("key", F.lit(PARTS))
    sizes = write_table(keys.groupBy(part.alias("part")).agg(F.count("*").alias("n")), "key-parts")
    cut = max(HOT_ROWS, (sizes.agg(F.sum("n")).first()[0] or 0) // HOT_KEYS)
    hot = [r.part for r in sizes.where(F.col("n") > cut).collect()]  # HOT_KEYS at most
    release(sizes)
    same = F.count("*").over(Window.partitionBy("key"))
    out = [write_table((r.where(~part.isin(hot)) if hot else r).withColumn("n", same).where("n > 1"), "shared-rows") for r in rows]
    if hot:
        counts = write_table(keys.where(part.isin(hot)).groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "hot-keys")
        rest = reduce(DataFrame.unionByName, [r.where(part.isin(hot)) for r in rows])
        out.append(write_table(hot_join(rest, counts, "key"), "shared-rows"))
        release(counts)
    return out


def buckets(rows: DataFrame) -> DataFrame:
    """(key, id, n): members of the buckets with more than one, and how many these are; from rows (id, keys), keys an array."""
    each = rows.select("id", F.explode("keys").alias("key"))
    shared = write_table(each.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "shared-keys")
    members = write_table(hot_join(each, shared, "key"), "buckets")
    release(shared)
    return members


def leaders(members: DataFrame) -> DataFrame:
    """(key, b, n): each bucket's leader and size."""
    score = members.groupBy("id").agg(F.sum("n").alias("score"))
    return members.join(score.hint("merge"), "id").groupBy("key").agg(F.max(F.struct("score", "id")).alias("m"), F.count("*").alias("n")).select("key", F.col("m.id").alias("b"), "n")


def _row_of(values: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Flat values of a list column and the number of the row of each."""
    return values.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(values)), values.value_lengths().to_numpy(zero_copy_only=False))


def similarities(pairs: DataFrame, content: DataFrame) -> DataFrame:
    """(a, b, sim): the exact (weighted) Jaccard similarity of each pair (a, b).

    content: (id, elements) and weights too, if they are not all 1. Each id's content is joined by the number of its
    pairs, so one that a third of all others meet goes to many tasks.
    """
    weighted = "weights" in content.columns
    sized = content.select("id", "elements", *(["weights"] if weighted else []))

    def with_content(rows: DataFrame, side: str) -> DataFrame:
        names = {"id": side, "elements": f"e{side}", "weights": f"w{side}"}
        mine = sized.select(*[F.col(c).alias(names[c]) for c in sized.columns])
        return hot_join(rows, mine, side, sizes=pairs.groupBy(side).agg(F.count("*").alias("n")))

    columns = ["ea", "eb", "wa", "wb"] if weighted else ["ea", "eb"]
    both = with_content(with_content(pairs.select("a", "b"), "a"), "b").select("a", "b", *columns)
    out = pairs.select("a", "b").withColumn("sim", F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 1024):
                batch = whole.slice(k, 1024)
                n = batch.num_rows
                (x, p), (y, q) = _row_of(batch.column("ea")), _row_of(batch.column("eb"))
                u, v = (batch.column("wa").flatten().to_numpy(), batch.column("wb").flatten().to_numpy()) if weighted else (np.ones(len(x)), np.ones(len(y)))
                element, row, weight = np.concatenate([x, y]), np.concatenate([p, q]), np.concatenate([u, v])
                order = np.lexsort((element, row))
                element, row, weight = element[order], row[order], weight[order]
                same = np.flatnonzero((row[1:] == row[:-1]) & (element[1:] == element[:-1]))  # an element is once in a set
                inner = np.bincount(row[same], np.minimum(weight[same], weight[same + 1]), n)
                union = np.bincount(row, weight, n) - inner
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(np.divide(inner, union, out=np.zeros(n), where=union > 0))], names=["a", "b", "sim"])

    return both.mapInArrow(run, out)


def components(links: DataFrame) -> DataFrame:
    """(id, label): each linked id and the least id of its component.

    Labels go to the least of the neighbours' and, from the second round on, to their label's label, until no neighbour
    has a lesser one. An id is a neighbour of itself, so a round is one join and one aggregate; it is written to the
    shared folder, and only whether anything changed comes to the driver. An id that very many link to is dealt over
    tasks, as neighbour and as label.
    """
    turned = F.array(*[F.struct(F.col(x).alias("a"), F.col(y).alias("b")) for x, y in ("ab", "ba", "aa", "bb")])
    edges = write_table(links.select(F.explode(turned).alias("e")).select("e.a", "e.b").distinct(), "edges")
    labels = write_table(edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("label"), F.count("*").alias("n")), "labels")
    own, first = F.col("a") == F.col("b"), True
    while True:
        near = hot_join(edges, labels.select(F.col("id").alias("b"), "label", "n"), "b").groupBy(F.col("a").alias("id"))
        hop = near.agg(F.max(F.when(own, F.col("n"))).alias("n"), F.min(F.when(own, F.col("label"))).alias("old"), F.min("label").alias("label"))
        hop = write_table(hop.select("id", "n", "label", (F.col("label") != F.col("old")).alias("moved")), "hops")
        release(labels)
        if hop.where("moved").isEmpty():
            release(edges)
            return hop.select("id", "label")
        if first:
            labels, first = hop, False
            continue
        far = hop.groupBy("label").agg(F.count("*").alias("m")).join(hop.select(F.col("id").alias("label"), F.col("label").alias("far")).hint("merge"), "label")
        jump = hot_join(hop.select("id", "n", "label"), far, "label", "inner", "m")
        labels = write_table(jump.select("id", "n", F.least("label", "far").alias("label")), "labels")
        release(hop)


def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """(id, label) as components() gives them once these links (a, b) are there too: components of labels, not of ids."""
    ends = write_table(links.select(F.explode(F.array("a", "b")).alias("id")).distinct().join(labels.hint("merge"), "id", "left").select("id", F.coalesce("label", "id").alias("label"), F.col("label").isNull().alias("fresh")), "ends")
    pairs = links.select("a", "b")
    for side, to in (("a", "x"), ("b", "y")):
        pairs = hot_join(pairs, ends.select(F.col("id").alias(side), F.col("label").alias(to)), side, sizes=links.groupBy(side).agg(F.count("*").alias("n")))
    moved = components(pairs.where("x != y").select(F.col("x").alias("a"), F.col("y").alias("b")))
    every = labels.select("id", "label").unionByName(ends.where("fresh").select("id", "label"))
    moved = moved.select(F.col("id").alias("label"), F.col("label").alias("to"))
    out = hot_join(every, moved, "label", "left", sizes=every.groupBy("label").agg(F.count("*").alias("n")))
    out = write_table(out.select("id", F.coalesce("to", "label").alias("label")), "labels")
    release(ends)
    return out


def shared_weights(content: DataFrame) -> DataFrame:
    """content (id, label, elements[, weights]) with total, an id's weight, and shared, that of elements which others have too.

    Elements that one id alone has are found by an aggregate that combines early; frequent elements never meet their ids.
    """
    weighted = "weights" in content.columns
    pair = "arrays_zip(elements, weights)" if weighted else "transform(elements, x -> named_struct('elements', x, 'weights', 1))"
    each = content.select("id", F.expr(f"explode({pair})").alias("p")).select("id", "p.elements", F.col("p.weights").cast("long").alias("w"))
    alone = each.groupBy("elements").agg(F.count("*").alias("n"), F.first("id").alias("id"), F.first("w").alias("w")).where("n = 1").groupBy("id").agg(F.sum("w").alias("alone"))
    total = F.expr("aggregate(weights, 0L, (n, w) -> n + w)") if weighted else F.size("elements").cast("long")
    return content.withColumn("total", total).join(alone.hint("merge"), "id", "left").withColumn("shared", F.col("total") - F.coalesce("alone", F.lit(0))).drop("alone")


def _sketched(content: DataFrame) -> DataFrame:
    """(id, total, shared, sketch): BITS bits of the id's signature, as longs."""
    weighted = "weights" in content.columns
    rows = content.select("id", "total", "shared", "elements", *(["weights"] if weighted else []))
    out = rows.select("id", "total", "shared", F.array(F.lit(0).cast("long")).alias("sketch")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 512):
                batch = whole.slice(k, 512)
                element, row = _row_of(batch.column("elements"))
                element = element.view(np.uint64)
                sig = bag_minhash(row, element, batch.column("weights").flatten().to_numpy().astype(np.int64), batch.num_rows, BITS) if weighted else minhash(row, element, batch.num_rows, BITS)
                bits = minhash_bits(sig)
                sketch = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1) * bits.shape[1], pa.int32()), pa.array(bits.reshape(-1)))
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], sketch], names=["id", "total", "shared", "sketch"])

    return rows.mapInArrow(run, out)


def _mixed(members: DataFrame) -> DataFrame:
    """members (key, id, label, ...) of the keys that hold several labels, with m, how many these are."""
    several = write_table(members.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count("*").alias("m")).where("x != y").select("key", "m"), "mixed-keys")
    return hot_join(members, several, "key", n="m")


def rest_pairs(met: DataFrame, labels: DataFrame, rows: DataFrame, content: DataFrame, known: DataFrame, least: float, sketches: bool = True) -> DataFrame:
    """(a, b): ids of different components that can have similarity `least`, of those (met: key, id) that share a bucket
    with a third one, their leader, which both have met; pairs already known (a, b, sim) are left out.

    Exact bounds come first, before anything is paired: a pair of similarity `least` has at least least / (1 + least) of
    both weights together in common, which is no more than either shares with anything. What passes must also, if wanted,
    have sketches that agree to DEVIATIONS. A bucket is split into blocks of about BLOCK members, and each pair of blocks
    is a key of its own. A pair that shares several buckets is made in that of the least key only.
    """
    own = write_table(_mixed(met.join(labels.hint("merge"), "id", "left").select("key", "id", F.coalesce("label", "id").alias("label"))).drop("m"), "mixed-members")
    mine = content.join(own.select("id").distinct().hint("merge"), "id", "left_semi")
    able = shared_weights(mine).where(F.col("shared") >= least * F.col("total") - 1e-9)
    if sketches:
        # written first, so that as many Python tasks begin as the rows ask for, and not as many as a join's partitions
        weights = write_table(able, "shared-weights")
        able = write_table(_sketched(weights), "able")
        release(weights)
    else:
        able = write_table(able.select("id", "total", "shared", F.lit(None).cast("array<long>").alias("sketch")), "able")
    dealt = _mixed(own.join(able.select("id").hint("merge"), "id")).withColumn("blocks", F.ceil(F.col("m") / BLOCK).cast("int"))
    dealt = write_table(dealt.withColumn("own", F.pmod(F.xxhash64("id"), "blocks").cast("int")).join(able.hint("merge"), "id").join(rows.select("id", "keys").distinct().hint("merge"), "id"), "dealt-members")
    release(own, able)
    all_blocks = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    side = lambda own, other, **names: dealt.select("key", F.col("own").alias(own), all_blocks.alias(other), *[F.col(c).alias(n) for c, n in names.items()]).repartition("key", "i", "j")  # noqa: E731  blocks are small, so none needs to be split
    one = side("i", "j", id="a", label="x", total="s", shared="u", sketch="p", keys="g")
    two = side("j", "i", id="b", label="y", total="t", shared="v", sketch="q", keys="h").hint("merge")
    fits = (one.key == two.key) & (one.i == two.i) & (one.j == two.j) & (F.col("x") < F.col("y"))
    fits = fits & (F.least("u", "v") >= least / (1 + least) * (F.col("s") + F.col("t")) - 1e-9) & (F.least("s", "t") >= least * F.greatest("s", "t") - 1e-9)
    if sketches:
        differ = (1 - least) / 2
        most = int(BITS * differ + DEVIATIONS * sqrt(BITS * differ * (1 - differ)))
        bits = " + ".join(f"bit_count(p[{k}] ^ q[{k}])" for k in range(BITS // 64))  # spelled out: this is done for all pairs within the bounds
        fits = fits & F.expr(f"{bits} <= {most}")
    fits = fits & F.expr("array_min(array_intersect(g, h))").eqNullSafe(one.key)
    pairs = one.join(two, fits).select("a", "b").distinct()
    fresh = write_table(pairs.join(known.select("a", "b").union(known.select("b", "a")).hint("merge"), ["a", "b"], "left_anti"), "rest-pairs")
    release(dealt)
    return fresh


def classes(rows: DataFrame, content_of, least: float, sketches: bool = True) -> tuple[DataFrame, DataFrame]:
    """((id, label) of each linked id, content) of rows (id, keys); content_of(ids) gives (id, elements[, weights], ...)."""
    members = buckets(rows)
    first = write_table(leaders(members), "leaders")
    content = write_table(content_of(members.select("id").distinct()), "content")
    met = write_table(hot_join(members.select("key", "id"), first, "key").where("id != b").select("key", "id", "b"), "met")
    release(members, first)
    pairs = write_table(met.select(F.col("id").alias("a"), "b").distinct(), "pairs")
    known = write_table(similarities(pairs, content), "similarities")
    links = known.where(F.col("sim") >= least)
    labels = components(links)
    more = rest_pairs(met, labels, rows, content, known, least, sketches)
    release(met, pairs)
    if not more.isEmpty():
        extra = write_table(similarities(more, content), "similarities").where(F.col("sim") >= least)
        if not extra.isEmpty():
            labels = joined(labels, extra)
    release(known, more)
    return labels, content
