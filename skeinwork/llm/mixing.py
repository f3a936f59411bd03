"""Mixing sources to target weights: temperature by bisection, then budgeted permutations of blocks."""

from __future__ import annotations

from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, batches_by_bytes, write_table
from .tokens import piece_bpe_counts

#: Least blocks of a source, and tokens of a block of the greatest source where that asks for more.
BLOCKS, BLOCK_TOKENS = 256, 50_000_000
#: Share of the greatest entropy (all sources alike) that the mix is to reach, and most times a document may be used.
ENTROPY, REPEATS = 0.95, 4.0


def count_words(text: Column) -> Column:
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), "[" + SPACES + "]+"), lambda w: w != "")).cast("long")


def count_tokens(text: Column, model_path: str) -> Column:
    """Tokens of a sentencepiece model, counted about 2 MB of text at a time."""

    def counts(texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts], names=["text"])
        return pa.array(np.concatenate([piece_bpe_counts(t["text"], model_path) for t in batches_by_bytes(iter([batch]), 2 << 20)] or [np.zeros(0, np.int64)]), pa.int64())

    return F.arrow_udf(counts, "long")(F.coalesce(text, F.lit("")))


def _measured(shares: DataFrame, exponents: list[float], scale: float) -> list[tuple[float, float]]:
    """For each exponent: the entropy of the normalised powers of shares, and the most often any source is repeated."""
    p = F.col("p")
    aggs = [f(a).alias(f"{n}{k}") for k, a in enumerate(exponents) for n, f in (("z", lambda a: F.sum(F.pow(p, F.lit(a)))), ("s", lambda a: F.sum(F.pow(p, F.lit(a)) * F.log(p))), ("r", lambda a: F.max(F.pow(p, F.lit(a - 1.0)))))]
    row = shares.agg(*aggs).first()
    return [(log(row[f"z{k}"]) - a * row[f"s{k}"] / row[f"z{k}"], scale * row[f"r{k}"] / row[f"z{k}"]) for k, a in enumerate(exponents)]


def bisect_exponent(shares: DataFrame, n_sources: int, scale: float, entropy: float = ENTROPY, repeats: float = REPEATS, rounds: int = 4) -> float:
    """The greatest exponent in [0, 1] that reaches the target entropy, or the least one that keeps the repetition limit if that is greater.

    Entropy falls and repetition falls as the exponent grows, so both are found by bisection; each round measures 15
    exponents (four halvings) in one aggregate over the sources, and only sums come to the driver.
    """
    low_e, high_e, low_r, high_r = 0.0, 1.0, 0.0, 1.0
    goal = entropy * log(n_sources) if n_sources > 1 else 0.0
    for k in range(rounds):
        grid = lambda lo, hi: [lo + (hi - lo) * i / 16 for i in range(0 if k == 0 else 1, 17 if k == 0 else 16)]
        a, b = grid(low_e, high_e), grid(low_r, high_r)
        found = _measured(shares, a + b, scale)
        for x, (h, _) in zip(a, found, strict=False):
            if h >= goal - 1e-12:
                low_e = max(low_e, x)
        high_e = min([high_e] + [x for x, (h, _) in zip(a, found, strict=False) if x > low_e])
        for x, (_, r) in zip(b, found[len(a) :], strict=True):
            if r > repeats:
                low_r = max(low_r, x)
        if k == 0 and found[len(a)][1] <= repeats:
            high_r = 0.0
        high_r = min([high_r] + [x for x, (_, r) in zip(b, found[len(a) :], strict=True) if r <= repeats and x >= low_r])
    return round(max(low_e, high_r), 6)


def mix(docs: DataFrame, entropy: float = ENTROPY, repeats: float = REPEATS, budget: int | None = None, blocks: int = BLOCKS, block_tokens: int = BLOCK_TOKENS, seed: int = 7, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", with_row: bool = False, model_path: str | None = None) -> DataFrame:
    """One row per use of a document: doc_id, source, epoch, block_rank, block, n_tokens, weight.

    Tokens are those of the sentencepiece model at model_path; without one, words. A source's weight is its share of all
    tokens to the power found by bisect_exponent, normalised; its quota is
    that of the budget (the corpus' tokens, if not given). Each source is dealt into blocks by hash, `blocks` of them or
    as many as hold about block_tokens each in the greatest source, so a block is one task's work at any size. Epoch e is a permutation of a source's blocks; whole epochs use all
    of them, the last one those that fit the rest of the quota and, of the block at its edge, documents (in hash order)
    up to it: a source misses its quota by less than one document. A null source is a source of its own. Sources without
    a token have no weight and give no rows; null or empty texts of others go with their block. Repeated rows are used
    each; rows without an id are dealt by their text. An empty table gives no rows. with_row adds the input row, a struct.
    """
    row = [F.struct(*[docs[c] for c in docs.columns]).alias("row")] if with_row else []
    more = ["row"] if with_row else []
    dealt = F.coalesce(docs[id_col].cast("long"), F.xxhash64(docs[text_col]))
    named = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[source_col].cast("string").alias("source"), (count_tokens(docs[text_col], model_path) if model_path else count_words(docs[text_col])).alias("n_tokens"), dealt.alias("dealt"), *row)
    key = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    rows = write_table(named.withColumn("key", key), "mix-rows")
    sources = write_table(rows.groupBy("key").agg(F.sum("n_tokens").alias("tokens")).where("tokens > 0"), "mix-sources")
    total, n, most = sources.agg(F.sum("tokens"), F.count("*"), F.max("tokens")).first()
    blocks = max(blocks, -(-(most or 0) // block_tokens))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("dealt", F.lit(seed)), F.lit(blocks)).cast("int"))
    held = rows.groupBy("key", "block").agg(F.sum("n_tokens").alias("tokens"))
    if not n:
        return rows.select("doc_id", "source", F.lit(0).alias("epoch"), F.lit(0).alias("block_rank"), "block", "n_tokens", F.lit(0.0).alias("weight"), *more).where(F.lit(False))
    budget = int(budget or total)
    shares = sources.select("key", "tokens", (F.col("tokens") / F.lit(total)).alias("p"))
    exponent = bisect_exponent(shares, n, budget / total, entropy, repeats)
    z = shares.agg(F.sum(F.pow("p", F.lit(exponent)))).first()[0]
    weight = F.pow("p", F.lit(exponent)) / F.lit(z)
    quotas = shares.select("key", "tokens", weight.alias("weight"), F.floor(F.lit(budget) * weight).cast("long").alias("quota"))
    # every (source, epoch, block) with its place in that epoch's permutation and the tokens before it
    epochs = quotas.select("key", "tokens", "weight", "quota", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("quota") / F.col("tokens")))).alias("epoch"))
    turns = held.withColumnRenamed("tokens", "block_tokens").join(epochs, "key")
    order = Window.partitionBy("key", "epoch").orderBy(F.xxhash64("epoch", "block", F.lit(seed + 1)), "block")
    turns = turns.select("key", "block", "weight", "epoch", "block_tokens", F.least(F.col("quota") - F.col("epoch") * F.col("tokens"), F.col("tokens")).alias("most"), F.row_number().over(order).alias("block_rank"), (F.sum("block_tokens").over(order) - F.col("block_tokens")).alias("before"))
    turns = turns.withColumn("room", F.col("most") - F.col("before")).where("room > 0")
    within = Window.partitionBy("key", "block").orderBy(F.xxhash64("dealt", F.lit(seed + 2)), "dealt").rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumn("upto", F.sum("n_tokens").over(within))
    used = placed.join(turns.select("key", "block", "weight", "epoch", "block_rank", "room"), ["key", "block"]).where("upto <= room")
    return used.select("doc_id", "source", F.col("epoch").cast("int").alias("epoch"), "block_rank", "block", "n_tokens", "weight", *more)


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", seed: int = 7, **options) -> DataFrame:
    """docs with each row as often as the mix uses it, with all their columns, in the order of the mix.

    Partitions are ranges of (epoch, block_rank), so what reads them in turn meets the sources' blocks side by side, in
    the shares of the mix; within a rank, documents of all sources are in hash order (repeated and null ids as they
    come). A rank may be many partitions.
    """
    order = ["epoch", "block_rank", F.xxhash64("doc_id", F.lit(seed))]
    return mix(docs, id_col=id_col, seed=seed, with_row=True, **options).repartitionByRange(*order).sortWithinPartitions(*order).select("row.*")
