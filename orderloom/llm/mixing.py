"""Mixing sources to target weights by Poisson replication. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import staged, text_or_empty, uniform

SALTS = 16


def source_rates(docs: DataFrame, weights: Mapping[str | None, float] | None = None, temper: float = 0.5,
                 budget: float = 1.0, source_col: str = "source", text_col: str = "text") -> DataFrame:
    """One row per source: ``source, n_docs, mass, rate, cdf``.

    The mass of a document is its characters plus one. A source's share of the mixed corpus is its weight over the
    sum of weights: the given ones (a source not named gets 0), or else mass to the power ``temper``. ``rate`` is
    the mean number of copies that brings a source to its share of ``budget`` times the present mass. ``cdf[k]`` is
    the Poisson probability of at most k copies, carried to twelve deviations beyond the mean.
    """
    sizes = (docs.select(F.col(source_col).alias("source"), (F.length(text_or_empty(text_col)) + 1).alias("_mass"))
             .groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("_mass").alias("mass")))
    if weights is None:
        weight = F.pow(F.col("mass").cast("double"), F.lit(float(temper)))
    else:
        weight = F.lit(0.0)
        for name, value in weights.items():
            same = F.col("source").eqNullSafe(F.lit(name))
            weight = F.when(same, F.lit(float(value))).otherwise(weight)
    weighed = staged(sizes.withColumn("_weight", weight), "sources")
    sums = weighed.agg(F.sum("mass"), F.sum("_weight")).first()
    total, weights_sum = float(sums[0] or 0), float(sums[1] or 0)
    share = F.col("_weight") / F.lit(weights_sum) if weights_sum > 0 else F.lit(0.0)
    rated = weighed.withColumn("rate", F.lit(float(budget) * total) * share / F.col("mass"))
    last = F.ceil(F.col("rate") + 12 * F.sqrt("rate") + 30).cast("int")
    # in logarithms, so that large rates do not underflow: ln p(k) = k ln rate - rate - ln k!
    start = F.struct(F.negative("rate").alias("ln_p"), F.exp(F.negative("rate")).alias("sum"),
                     F.array(F.exp(F.negative("rate"))).alias("cdf"))

    def step(acc, k):
        ln_p = acc["ln_p"] + F.ln("rate") - F.ln(k.cast("double"))
        total_p = acc["sum"] + F.exp(ln_p)
        return F.struct(ln_p.alias("ln_p"), total_p.alias("sum"),
                        F.concat(acc["cdf"], F.array(total_p)).alias("cdf"))

    cdf = F.when(F.col("rate") > 0, F.aggregate(F.sequence(F.lit(1), last), start, step)["cdf"])
    return rated.withColumn("cdf", F.coalesce(cdf, F.array(F.lit(1.0)))).select(
        "source", "n_docs", "mass", "rate", "cdf")


def mix(docs: DataFrame, weights: Mapping[str | None, float] | None = None, temper: float = 0.5, budget: float = 1.0,
        seed: str = "mix", id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        shuffle: bool = True) -> DataFrame:
    """Every copy that the mixed corpus holds: the columns of ``docs``, then ``_copy`` (from 1), ``_copies``,
    ``_rate`` and ``_shuffle``, in the order of ``_shuffle``, a hash of id and copy.

    The number of copies inverts the Poisson distribution at a hash of seed and id, so a rerun or a retried task
    gives the same copies. Rates meet the rows by source and salt: a source with a third of all rows is dealt to
    SALTS tasks, unless the planner finds the rates small enough to broadcast.

    A null source is a source of its own; a null or empty text has mass 1. Rows that repeat under one id get the
    same number of copies each; a null id is hashed like the empty string. An empty table gives no rows. Columns
    that bear the names above are replaced; those that begin with ``_mix_`` may not be there; others pass unchanged.
    """
    own = ["_copy", "_copies", "_rate", "_shuffle"]
    docs = docs.drop(*own)
    rates = source_rates(docs, weights, temper, budget, source_col, text_col)
    rates = staged(rates.select(F.col("source").alias("_mix_source"), F.col("rate").alias("_rate"),
                                F.col("cdf").alias("_mix_cdf")), "rates")
    dealt = rates.withColumn("_mix_block", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    id_text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    rows = (docs.withColumn("_mix_id", id_text).withColumn("_mix_at", uniform(seed, "_mix_id"))
            .withColumn("_mix_salt", F.pmod(F.hash("_mix_id"), F.lit(SALTS))))
    same = F.col(source_col).eqNullSafe(F.col("_mix_source")) & (F.col("_mix_salt") == F.col("_mix_block"))
    met = rows.join(dealt, same)
    copies = F.size(F.filter("_mix_cdf", lambda p: p <= F.col("_mix_at")))
    out = (met.withColumn("_copies", copies).filter("_copies > 0")
           .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
           .withColumn("_shuffle", uniform(seed + "/order", "_mix_id", "_copy")))
    out = out.select(*docs.columns, *own)
    return out.orderBy("_shuffle", id_col, "_copy") if shuffle else out
