"""Mixing sources to target weights by iterative proportional fitting (raking), on DataFrame functions alone.

Tokens are summed by cell (source, language, topic).  Starting from ``fraction`` of each cell, every round scales the cells
of a source, then of a language, then of a topic to that margin's target, never beyond the tokens a cell has, until a round
moves no probability by more than ``TOLERANCE`` (looked at every ``BLOCK`` rounds, ``ROUNDS`` at most).  A document of the
cell is then kept with probability weight / tokens, by a hash of its id, so expected tokens meet the margins as far as the
cells allow; :func:`margin_errors` tells target and tokens reached for each value.  Targets default to ``fraction`` of all
tokens, shared by margin in proportion to tokens ** ``alpha`` (at most 1), which lifts small margins and holds down a
dominant one; what a value has not got is shared by the others of its margin, so no default target is beyond reach of its margin.

Only cells are raked, one row for each combination of values that occurs; up to ``ONE_TASK_CELLS`` of them (counted) in one
task, more by shuffles on the margins' values.  Null or missing values form the margin '', documents without words are in
no need of weight and have the probability of their cell; rows with equal ids share their fate; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blockloom.llm.tables import Carried, join_small, stored

ALPHA, FRACTION = 0.7, 0.5
ROUNDS, BLOCK, TOLERANCE = 96, 12, 1e-4
ONE_TASK_CELLS = 50_000
WORD = r"[^\x20\x09-\x0D]+"
MARGINS = ("source", "lang", "topic")
#: Topics by strings a text holds, the first that fits; none fits: prose.
TOPICS: Sequence[tuple[str, tuple[str, ...]]] = (
    ("legal", ("icense", "ights reserved", "opyright")),
    ("contact", ("@",)),
    ("table", (" | ",)),
    ("noise", ("%%%", "###", "!! ")),
)


def topic_of(text: Column) -> Column:
    out = None
    for name, marks in TOPICS:
        fits = F.lit(False)
        for mark in marks:
            fits = fits | F.contains(text, F.lit(mark))
        out = F.when(fits, name) if out is None else out.when(fits, name)
    return F.when(text.isNull(), "prose").otherwise(out.otherwise("prose"))


def uniform(id: Column, seed: str) -> Column:
    """A number in [0, 1) from the id alone."""
    return F.conv(F.substring(F.md5(F.concat(F.coalesce(id.cast("string"), F.lit("null")), F.lit(":" + seed))), 1, 13), 16, 10).cast("double") / float(1 << 52)


def margin_targets(cells: DataFrame, margin: str, alpha: float = ALPHA, fraction: float = FRACTION) -> DataFrame:
    """(value, t_value) of one margin: the least of the tokens held and rate * held ** alpha, with the rate that fills the mixture.

    A rate that leaves some values short is raised for the others; each step is an aggregation over the values.
    """
    values = stored(cells.groupBy(margin).agg(F.sum("tokens").cast("double").alias("held")))
    lifted, rate = F.pow("held", F.lit(alpha)), 0.0
    while True:
        full = F.lit(rate) * lifted >= F.col("held")
        r = values.agg(F.sum("held").alias("all"), F.sum(F.when(full, F.col("held"))).alias("full"), F.sum(F.when(~full, lifted)).alias("rest")).first()
        higher = (fraction * r["all"] - (r["full"] or 0.0)) / r["rest"] if r["rest"] else 0.0
        if higher <= rate * (1 + 1e-12):
            return values.select(margin, F.least("held", F.lit(rate) * lifted).alias(f"t_{margin}"))
        rate = higher


def rake(cells: DataFrame, alpha: float = ALPHA, fraction: float = FRACTION, rounds: int = ROUNDS, targets: DataFrame | None = None) -> DataFrame:
    """``cells`` (source, lang, topic, tokens; no nulls) with ``weight``, their tokens after raking, and the targets of their values.

    ``targets`` (margin, value, target) overrides the tokens wanted of single values.
    """
    cells = stored(cells)
    few = cells.count() <= ONE_TASK_CELLS
    raked = cells
    for m in MARGINS:
        raked = raked.join(margin_targets(cells, m, alpha, fraction), m)
        if targets is not None:
            own = targets.where(F.col("margin") == m).select(F.col("value").alias(m), F.col("target").cast("double").alias("own"))
            raked = raked.join(own, m, "left").withColumn(f"t_{m}", F.coalesce("own", f"t_{m}")).drop("own")
    raked = raked.select(*MARGINS, "tokens", *[f"t_{m}" for m in MARGINS], (F.col("tokens") * F.lit(fraction)).alias("weight"))
    for done in range(0, rounds, BLOCK):
        if few:
            raked = raked.coalesce(1)  # one partition satisfies every window below
        steps = min(BLOCK, rounds - done)
        for step in range(steps):
            if step == steps - 1:
                raked = raked.withColumn("before", F.col("weight"))
            for m in MARGINS:
                now = F.sum("weight").over(Window.partitionBy(m))
                raked = raked.withColumn("weight", F.when(now > 0, F.least(F.col("tokens").cast("double"), F.col("weight") * F.col(f"t_{m}") / now)).otherwise(F.col("weight")))
        raked = stored(raked)
        moved = raked.agg(F.max(F.abs(F.col("weight") - F.col("before")) / F.greatest("tokens", F.lit(1)))).first()[0]
        raked = raked.drop("before")
        if moved is None or moved <= TOLERANCE:
            break
    return raked


def margin_errors(raked: DataFrame) -> DataFrame:
    """(margin, value, tokens, target, reached, error) of raked cells; the error is a share of the target."""
    parts = [
        raked.groupBy(F.lit(m).alias("margin"), F.col(m).alias("value")).agg(F.sum("tokens").alias("tokens"), F.max(f"t_{m}").alias("target"), F.sum("weight").alias("reached"))
        for m in MARGINS
    ]
    return reduce(DataFrame.union, parts).withColumn("error", F.when(F.col("target") > 0, F.col("reached") / F.col("target") - 1).otherwise(F.lit(0.0)))


def mix(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    lang: str = "lang",
    topic: str | None = None,
    alpha: float = ALPHA,
    fraction: float = FRACTION,
    rounds: int = ROUNDS,
    seed: str = "mix",
    targets: DataFrame | None = None,
) -> DataFrame:
    """``docs`` with topic, n_tokens, probability and kept added (in place of columns of these names)."""
    held = Carried(docs, id=id, text=text, source=source, lang=lang, topic=topic)
    words = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("bigint")
    named = topic_of(F.col("text")) if topic is None else F.coalesce(F.col("topic").cast("string"), F.lit(""))
    rows = held.df.withColumns(
        {"topic": named, "n_tokens": words, "source": F.coalesce(F.col("source").cast("string"), F.lit("")), "lang": F.coalesce(F.col("lang").cast("string"), F.lit(""))}
    )
    cells = rows.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("tokens"))
    chance = F.when(F.col("tokens") > 0, F.round(F.col("weight") / F.col("tokens"), 9)).otherwise(F.lit(fraction))
    cells = rake(cells, alpha, fraction, rounds, targets).select(F.struct(*MARGINS).alias("cell"), chance.alias("probability"))
    out = join_small(rows.withColumn("cell", F.struct(*MARGINS)), cells, "cell").withColumn("kept", uniform(F.col("id"), seed) < F.col("probability"))
    return held.back(out, added=["topic", "n_tokens", "probability", "kept"])


def oracle(alpha: float = ALPHA, fraction: float = FRACTION, rounds: int = ROUNDS, seed: str = "mix", table: str = "documents", keep: bool = False) -> str:
    """The same for DuckDB: documents with their probability, or (``keep``) the kept documents."""
    topics = " ".join(f"WHEN {' OR '.join(f'''contains(text, '{m}')''' for m in marks)} THEN '{name}'" for name, marks in TOPICS)
    steps = [
        f"mix_rows AS MATERIALIZED (SELECT *, CASE {topics} ELSE 'prose' END AS topic_, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS n_tokens_, coalesce(source, '') AS s_, coalesce(lang, '') AS l_ FROM {table})",
        "mix_cells AS MATERIALIZED (SELECT s_ AS source, l_ AS lang, topic_ AS topic, sum(n_tokens_)::DOUBLE AS tokens FROM mix_rows GROUP BY ALL)",
    ]
    for m in MARGINS:
        # values in order of their tokens: those below the first that the rate does not exhaust are taken whole
        steps.append(f"mix_p_{m} AS (SELECT {m}, sum(tokens) AS held, pow(sum(tokens), {alpha}) AS p FROM mix_cells GROUP BY 1)")
        rate = f"(sum(held) OVER () * {fraction} - coalesce(sum(held) OVER (ORDER BY held, {m} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(p) OVER (ORDER BY held, {m} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
        steps.append(f"mix_r_{m} AS MATERIALIZED (SELECT *, {rate} AS rate FROM mix_p_{m})")
        steps.append(f"mix_t_{m} AS MATERIALIZED (SELECT {m}, least(held, coalesce((SELECT rate FROM mix_r_{m} WHERE rate * p < held ORDER BY held, {m} LIMIT 1) * p, held)) AS t_{m} FROM mix_p_{m})")
    joins = " ".join(f"JOIN mix_t_{m} USING ({m})" for m in MARGINS)
    steps.append(f"mix_0 AS MATERIALIZED (SELECT *, tokens * {fraction} AS weight, 0::DOUBLE AS before, FALSE AS done FROM mix_cells {joins})")
    n = 0

    def step(change: str) -> None:
        nonlocal n
        steps.append(f"mix_{n + 1} AS MATERIALIZED (SELECT * REPLACE ({change}) FROM mix_{n})")
        n += 1

    for i in range(1, rounds + 1):
        last = i % BLOCK == 0 or i == rounds
        if last:
            step("weight AS before")
        for m in MARGINS:
            now = f"sum(weight) OVER (PARTITION BY {m})"
            step(f"CASE WHEN NOT done AND {now} > 0 THEN least(tokens, weight * t_{m} / {now}) ELSE weight END AS weight")
        if last:
            step(f"done OR (SELECT max(abs(weight - before) / greatest(tokens, 1)) FROM mix_{n}) <= {TOLERANCE} AS done")
    chance = f"CASE WHEN c.tokens > 0 THEN round(c.weight / c.tokens, 9) ELSE {fraction} END"
    steps.append(
        f"mix_out AS (SELECT r.*, {chance} AS probability_, ('0x' || substr(md5(coalesce(r.doc_id::VARCHAR, 'null') || ':{seed}'), 1, 13))::BIGINT / {float(1 << 52)!r} < {chance} AS kept_ "
        f"FROM mix_rows r JOIN mix_{n} c ON r.s_ = c.source AND r.l_ = c.lang AND r.topic_ = c.topic)"
    )
    body = "SELECT doc_id, text, lang, source, n_chars FROM mix_out WHERE kept_" if keep else "SELECT doc_id, source, lang, topic_ AS topic, n_tokens_ AS n_tokens, probability_ AS probability, kept_ AS kept FROM mix_out"
    return f"WITH {', '.join(steps)} {body}"
