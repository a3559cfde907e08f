"""Mixing sources to target weights by iterative proportional fitting (raking), in DataFrame operations only.

Documents are counted into cells (source, language, topic). A target is a weight for each source, language and topic: those
that the caller gives, else shares of the data raised to a power (TEMPER). A value can't give more tokens than it has, so
targets are first brought under that bound, and what is left over goes to the other values by their weights. Raking then
scales the expected tokens of the cells until their sums meet the targets of every source, language and topic in turn, each
cell held at the tokens it has; held cells take part in every sweep, so the others make up for them. A cell's expected
tokens over its tokens are the probability of its documents; a document is sampled if a hash of its id, as a number in
[0, 1), is below it, so that a rerun samples the same rows. Marginals can contradict each other under the bound;
reached() reports for every value what was asked for, what its own tokens allow, and what the fit gives.

Only the counts of cells are shuffled; each map task sums its own first, so a source with a third of all
rows costs no more than any other. Cells are as many as there are combinations of attributes, whatever the
number of documents; they are broadcast to the documents only up to MAX_BROADCAST_CELLS (counted), and
beyond it Spark joins by the cell's key and splits hot keys itself.

Defined results: a null source, language, topic or text is a value of its own ("\\u2205" in the cell's key,
0 tokens for a null text); a cell without tokens has probability 0; a value that given weights don't name has weight 0;
an id that repeats gets the same draw each time; a null id draws as the text "null"; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from isoforge.llm.common import materialise, table

MAX_BROADCAST_CELLS = 100_000
SWEEPS = 12
#: Sweeps of one plan; a longer one would be too deep.
PLANNED = 6
#: Rounds that bring targets under what values have.
CAP_ROUNDS = 4
KEEP_FRACTION = 0.75
#: Targets are shares raised to this power: 0 evens all values out, 1 leaves shares as they are.
TEMPER = {"source": 0.5, "lang": 0.7, "topic": 1.0}
#: Bytes of UTF-8 to a token, by which tokens are estimated.
TOKEN_BYTES = 4
NONE = "∅"


def topic_of(text: Column) -> Column:
    """A rough topic by the form of the text."""
    return F.when(text.isNull(), F.lit(None).cast("string")).when(text.contains(" | "), "table").when(text.contains("!! "), "shouting").when(text.contains("%%% ") | text.contains("&&& "), "symbols").when(text.contains("\n"), "prose").otherwise("snippet")


def uniform(id_: Column) -> Column:
    """A number in [0, 1) from the id, the same on every run."""
    return F.conv(F.substring(F.md5(F.coalesce(id_.cast("string"), F.lit("null")).cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(2.0**52)


def targets_of(cells: DataFrame, d: str, temper: float, weights: dict[str, float] | None, keep_fraction: float) -> DataFrame:
    """A row for each value of d: share (asked for) and target (tokens, at most those that the value has)."""
    everything = Window.partitionBy()  # over the few values
    df = cells.groupBy(d).agg(F.sum("__t").alias("have")).withColumn("all", F.sum("have").over(everything))
    if weights is None:
        df = df.withColumn("weight", F.pow(F.try_divide(F.col("have"), F.col("all")), F.lit(float(temper))))
    else:
        given = [(F.col(d) == value, float(w)) for value, w in weights.items()]
        df = df.withColumn("weight", F.coalesce(*(F.when(is_value, w) for is_value, w in given), F.lit(0.0)))
    df = df.withColumn("share", F.coalesce(F.try_divide(F.col("weight"), F.sum("weight").over(everything)), F.lit(0.0)))
    df = df.withColumn("want", keep_fraction * F.col("share") * F.col("all")).withColumn("scale", F.lit(1.0))
    for _ in range(CAP_ROUNDS):
        full = F.col("want") * F.col("scale") >= F.col("have")
        left = keep_fraction * F.col("all") - F.sum(F.when(full, F.col("have")).otherwise(0.0)).over(everything)
        free = F.sum(F.when(full, 0.0).otherwise(F.col("want"))).over(everything)
        df = df.withColumn("scale", F.greatest(F.col("scale"), F.coalesce(F.try_divide(left, free), F.col("scale"))))
    return df.select(d, "share", F.least(F.col("want") * F.col("scale"), F.col("have")).alias("target"))


def rake(cells: DataFrame, dims: dict[str, float], keep_fraction: float = KEEP_FRACTION, sweeps: int = SWEEPS, tokens: str = "tokens", weights: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """cells (a row for each combination, with its tokens) and keep_probability. dims: column -> temper. weights: column -> value -> weight."""
    base = cells.withColumn("__t", F.col(tokens).cast("double"))
    df = base.withColumn("__m", keep_fraction * F.col("__t"))
    for d, temper in dims.items():
        df = df.join(targets_of(base, d, temper, (weights or {}).get(d), keep_fraction).select(d, F.col("target").alias(f"__g_{d}")), d)
    rows = cells.count() if sweeps > PLANNED else 0
    for i in range(sweeps):
        if i and i % PLANNED == 0:
            df = materialise(df, "sweeps", rows)
        for d in dims:
            scaled = F.try_divide(F.col("__m") * F.col(f"__g_{d}"), F.sum("__m").over(Window.partitionBy(d)))
            df = df.withColumn("__m", F.least(F.col("__t"), F.coalesce(scaled, F.lit(0.0))))
    return df.select(*cells.columns, F.coalesce(F.try_divide(F.col("__m"), F.col("__t")), F.lit(0.0)).alias("keep_probability"))


DIMS = ["source", "lang", "topic"]


def documents(docs: DataFrame, id_col: str, text_col: str, source_col: str, lang_col: str, topic, carry: tuple[str, ...]) -> DataFrame:
    """__id, source, lang, topic, tokens, and the columns of carry as __c0, __c1, ... topic: a column's name, or Column -> Column of the text."""
    text = F.col(text_col).cast("string")
    named = lambda c: F.coalesce(c.cast("string"), F.lit(NONE))
    tokens = F.ceil(F.coalesce(F.octet_length(text), F.lit(0)) / TOKEN_BYTES).cast("long")
    return docs.select(
        F.col(id_col).alias("__id"), named(F.col(source_col)).alias("source"), named(F.col(lang_col)).alias("lang"), named(F.col(topic) if isinstance(topic, str) else topic(text)).alias("topic"), tokens.alias("tokens"),
        *(F.col(c).alias(f"__c{i}") for i, c in enumerate(carry)),
    )


def fit(rows: DataFrame, temper: dict[str, float], keep_fraction: float, sweeps: int, weights: dict[str, dict[str, float]] | None) -> DataFrame:
    """The cells of rows with their keep_probability, written."""
    cells = materialise(rows.groupBy(*DIMS).agg(F.sum("tokens").alias("tokens")), "cells")
    return materialise(rake(cells, {d: temper[d] for d in DIMS}, keep_fraction, sweeps, weights=weights), "raked", cells.count())


def calibrated(rows: DataFrame, fitted: DataFrame) -> DataFrame:
    """rows with keep_probability and sampled."""
    few = fitted.count() <= MAX_BROADCAST_CELLS
    fitted = fitted.select(*DIMS, "keep_probability")
    out = rows.join(F.broadcast(fitted) if few else fitted, DIMS)
    return out.withColumn("sampled", uniform(F.col("__id")) < F.col("keep_probability"))


def reached(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang", topic=topic_of, temper: dict[str, float] = TEMPER, keep_fraction: float = KEEP_FRACTION, sweeps: int = SWEEPS, weights: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """How well the fit meets its targets: dim, value, asked, allowed and reached (shares of the tokens to be kept), residual (reached less allowed)."""
    fitted = fit(documents(docs, id_col, text_col, source_col, lang_col, topic, ()), temper, keep_fraction, sweeps, weights)
    base = fitted.withColumn("__t", F.col("tokens").cast("double"))
    budget = keep_fraction * F.sum("have").over(Window.partitionBy())
    out = None
    for d in DIMS:
        sums = base.groupBy(d).agg(F.sum("__t").alias("have"), F.sum(F.col("__t") * F.col("keep_probability")).alias("kept"))
        one = sums.join(targets_of(base, d, temper[d], (weights or {}).get(d), keep_fraction), d).withColumn("budget", budget)
        one = one.select(F.lit(d).alias("dim"), F.col(d).alias("value"), F.col("share").alias("asked"), F.try_divide("target", "budget").alias("allowed"), F.try_divide("kept", "budget").alias("reached"))
        out = one if out is None else out.unionByName(one)
    return out.withColumn("residual", F.col("reached") - F.col("allowed"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang", topic=topic_of, temper: dict[str, float] = TEMPER, keep_fraction: float = KEEP_FRACTION, sweeps: int = SWEEPS, weights: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """A row for each row of docs: id, source, lang, topic, tokens, keep_probability, sampled.

    topic: the name of a column, or Column -> Column of the text. weights: {"source": {value: weight, ...}, ...} for any of source, lang and topic; they need not add up to 1.
    """
    rows = documents(docs, id_col, text_col, source_col, lang_col, topic, ())
    return calibrated(rows, fit(rows, temper, keep_fraction, sweeps, weights)).select(F.col("__id").alias(id_col), *DIMS, "tokens", "keep_probability", "sampled")


def sample_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang", topic=topic_of, temper: dict[str, float] = TEMPER, keep_fraction: float = KEEP_FRACTION, sweeps: int = SWEEPS, weights: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """The sampled rows of docs, all columns."""
    rows = documents(docs, id_col, text_col, source_col, lang_col, topic, tuple(docs.columns))
    out = calibrated(rows, fit(rows, temper, keep_fraction, sweeps, weights))
    return out.where("sampled").select(*(F.col(f"__c{i}").alias(c) for i, c in enumerate(docs.columns)))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).withColumn("keep_probability", F.round("keep_probability", 6))


def oracle() -> str:
    dims = list(TEMPER)
    steps = [
        f"""rows AS (SELECT doc_id, coalesce(source, '{NONE}') AS source, coalesce(lang, '{NONE}') AS lang,
  CASE WHEN text IS NULL THEN '{NONE}' WHEN contains(text, ' | ') THEN 'table' WHEN contains(text, '!! ') THEN 'shouting'
    WHEN contains(text, '%%% ') OR contains(text, '&&& ') THEN 'symbols' WHEN contains(text, chr(10)) THEN 'prose' ELSE 'snippet' END AS topic,
  CAST(ceil(coalesce(strlen(text), 0) / {TOKEN_BYTES}.0) AS BIGINT) AS tokens FROM documents)""",
        "cells AS (SELECT source, lang, topic, sum(tokens)::DOUBLE AS t FROM rows GROUP BY ALL)",
    ]
    steps.append(f"everything AS (SELECT sum(t) AS a, {KEEP_FRACTION} * sum(t) AS budget FROM cells)")
    for d in dims:
        steps.append(f"have_{d} AS (SELECT {d}, sum(t) AS have, pow(sum(t) / any_value(a), {TEMPER[d]}) AS w FROM cells, everything GROUP BY {d})")
        steps.append(f"{d}_0 AS (SELECT {d}, have, budget, w / sum(w) OVER () * budget AS want, 1.0::DOUBLE AS scale FROM have_{d}, everything)")
        for i in range(CAP_ROUNDS):
            steps.append(f"{d}_{i + 1} AS (SELECT * EXCLUDE (scale), greatest(scale, coalesce((budget - sum(CASE WHEN want * scale >= have THEN have ELSE 0 END) OVER ()) / nullif(sum(CASE WHEN want * scale >= have THEN 0 ELSE want END) OVER (), 0), scale)) AS scale FROM {d}_{i})")
    steps.append(f"m0 AS (SELECT *, {KEEP_FRACTION} * t AS m FROM cells)")
    n = 0
    for _ in range(SWEEPS):
        for d in dims:
            steps.append(f"m{n + 1} AS MATERIALIZED (SELECT x.* EXCLUDE (m), least(t, coalesce(m * least(g.want * g.scale, g.have) / nullif(sum(m) OVER (PARTITION BY x.{d}), 0), 0)) AS m FROM m{n} x JOIN {d}_{CAP_ROUNDS} g USING ({d}))")
            n += 1
    steps.append(f"fitted AS (SELECT source, lang, topic, coalesce(m / nullif(t, 0), 0) AS p FROM m{n})")
    draw = "('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT / 4503599627370496.0"
    return "WITH " + ",\n".join(steps) + f"\nSELECT doc_id, source, lang, topic, tokens, round(p, 6) AS keep_probability, {draw} < p AS sampled FROM rows JOIN fitted USING (source, lang, topic)"


ORACLE = oracle()
