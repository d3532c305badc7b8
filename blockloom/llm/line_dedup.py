"""Line dedup by an exact set-similarity join, on DataFrame functions alone.

A line's set holds its distinct words in lower case.  A line is removed if an earlier line, by (id, text hash where ids repeat, line number),
has a set whose Jaccard likeness to it is at least ``percent`` / 100; it does not matter whether that line is removed
itself.  Lines without words stay.

1. Words are counted in 2**RANK_BITS cells of their hash (a fixed number, collected), and a word ranks by its cell, rare
   cells first.  A token is one integer: rank above hash, so sorted tokens are in order of rarity.
2. Lines with equal sets form a class, which its earliest line stands for.  Only that line can stay.
3. Linked sets share one of their first ``n - ceil(n * percent / 100) + 1`` tokens.  Classes meet on these under the length
   and the positional filter and a parity filter: the 64-bit parities of two sets differ in no more bits than the sets
   differ in words.
4. First every class is compared with the earliest ``HUBS`` of each of its prefix tokens.  A class that is thereby removed
   is settled, so a group of near copies costs about its size.  Then the unsettled ones are joined with all earlier classes
   that were no hub of the token; a token of few classes has none.  Two linked sets share one of the first
   ``m - ceil(2 * m * percent / (100 + percent)) + 1`` tokens of the shorter one (m words): its *index* tokens.  So one side
   of that join holds index tokens alone, and the many pairs that meet on later, more common tokens of both are not made.
5. Pairs are verified with the words of both lines, read again from the texts for just the lines that occur in pairs.

A token that many lines share is dealt over several tasks in step 4, by the count of its cell; in step 5 the lines asked
for are broadcast up to a counted limit and joined by shuffles beyond.  Null texts stay null; rows that repeat in id and
text share their decisions; null ids come first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blockloom.llm.tables import Carried, stored

PERCENT = 90
RANK_BITS = 14
HUBS = 3
#: Lines of one token that a task takes at a time, and lines to verify that are broadcast.
TOKEN_ROWS, BROADCAST_LINES = 50_000, 500_000
_HASH_BITS = 63 - RANK_BITS
_LINE = ("id", "dh", "no")
WORD = r"[^\x20\x09-\x0D]"


def _words(text: Column) -> Column:
    """Words in lower case, and empty texts where spaces meet; splitting at one plain character needs no pattern."""
    other = F.lit(r"[\x09-\x0D]")
    return F.split(F.lower(F.when(F.rlike(text, other), F.regexp_replace(text, other, F.lit(" "))).otherwise(text)), " ")


def _hashes(line: Column) -> Column:
    return F.array_remove(F.array_distinct(F.transform(_words(line), lambda w: F.xxhash64(w))), F.xxhash64(F.lit("")))


def _lines(rows: DataFrame) -> DataFrame:
    return rows.where("text IS NOT NULL").select("id", "dh", F.posexplode(F.split("text", "\n")).alias("no", "line"))


def _ranks(rows: DataFrame) -> tuple[list[int], list[int]]:
    """The rank of each cell by its count of words, and the counts in order of rank."""
    words = rows.select(F.explode(_words(F.replace("text", F.lit("\n"), F.lit(" ")))).alias("word"))
    cells = words.where("word <> ''").groupBy(F.shiftrightunsigned(F.xxhash64("word"), 64 - RANK_BITS).cast("int").alias("cell")).count()
    counts = [0] * (1 << RANK_BITS)
    for r in cells.collect():  # at most 2**RANK_BITS rows
        counts[r["cell"]] = r["count"]
    order = sorted(range(len(counts)), key=lambda c: (counts[c], c))
    ranks = [0] * len(counts)
    for rank, cell in enumerate(order):
        ranks[cell] = rank
    return ranks, [counts[c] for c in order]


def _tokens(line: Column, ranks: list[int]) -> Column:
    table = F.split(F.lit(",".join(str(r << _HASH_BITS) for r in ranks)), ",").cast("array<bigint>")
    own = (1 << _HASH_BITS) - 1

    def token(h: Column) -> Column:
        rank = F.get(table, F.shiftrightunsigned(h, 64 - RANK_BITS).cast("int"))
        return rank.bitwiseOR(h.bitwiseAND(F.lit(own)))

    return F.sort_array(F.transform(_hashes(line), token))


def _salts(token: Column, counts: list[int]) -> Column:
    """Tasks over which a token's lines are dealt: one for each TOKEN_ROWS words that its cell counts."""
    rank, out, most = F.shiftrightunsigned(token, _HASH_BITS), F.lit(1), 1
    for i, c in enumerate(counts):  # counts ascend; a step where they have doubled
        if c >= 2 * most * TOKEN_ROWS:
            most = 2 * most
            while c >= 2 * most * TOKEN_ROWS:
                most *= 2
            out = F.when(rank >= i, F.lit(most)).otherwise(out)
    return out


def _may_link(percent: int, x: str, y: str) -> str:
    """SQL: length, positional and parity filter between entries x and y (n, at, sig)."""
    need = f"CAST(CEIL({percent} * ({x}.n + {y}.n) / {100 + percent}D) AS INT)"
    return (
        f"(100 * LEAST({x}.n, {y}.n) >= {percent} * GREATEST({x}.n, {y}.n) "
        f"AND LEAST({x}.n - {x}.at, {y}.n - {y}.at) + LEAST({x}.at, {y}.at) >= {need} "
        f"AND BIT_COUNT({x}.sig ^ {y}.sig) <= {x}.n + {y}.n - 2 * {need})"
    )


def _entries(classes: DataFrame) -> DataFrame:
    return classes.selectExpr("first", "n", "sig", "posexplode(prefix) AS (at, token)")


def _matched(pairs: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """``x`` of the pairs (x later, y earlier) whose sets have the likeness."""
    wanted = stored(pairs.select(F.explode(F.array("x", "y")).alias("line")).distinct().select("line.*"))
    known = F.broadcast(wanted) if wanted.count() <= BROADCAST_LINES else wanted
    lines = _lines(rows).alias("l").join(known.alias("w"), [F.col(f"l.{c}").eqNullSafe(F.col(f"w.{c}")) for c in _LINE], "left_semi")
    sets = stored(lines.select(F.struct(*_LINE).alias("line"), _hashes(F.col("line")).alias("words")))
    sets = sets.dropDuplicates(["line"])  # rows that repeat
    x, y = (sets.select(F.col("line").alias(c), F.col("words").alias(f"w{c}")) for c in "xy")
    both = F.size(F.array_intersect("wx", "wy"))
    either = F.size("wx") + F.size("wy") - both
    return pairs.join(x, "x").join(y, "y").where(both * 100 >= either * percent).select("x").distinct()


def kept_lines(rows: DataFrame, percent: int) -> DataFrame:
    """(id, dh, no) of the lines with words that stay; ``rows`` has id, text and dh, which tells rows of one id with different texts apart."""
    ranks, counts = _ranks(rows)
    n = F.size("tokens")
    length = n - F.ceil(n * percent / F.lit(100.0)).cast("int") + 1
    # asked of the line, as a filter on the tokens would make them a second time
    lines = _lines(rows).where(F.rlike("line", F.lit(WORD)))
    lines = lines.select(F.struct(*_LINE).alias("line"), _tokens(F.col("line"), ranks).alias("tokens"))
    lines = lines.select(
        "line",
        n.alias("n"),
        F.xxhash64("tokens").alias("k1"),
        F.xxhash64("tokens", F.lit(1)).alias("k2"),
        # a set so small that only an equal one is near enough has no prefix
        F.when((F.floor(n * 100 / F.lit(float(percent))) > n) | (length > 1), F.slice("tokens", F.lit(1), length)).otherwise(F.array().cast("array<bigint>")).alias("prefix"),
        F.aggregate("tokens", F.lit(0).cast("bigint"), lambda a, t: a.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), t.bitwiseAND(F.lit(63)).cast("int")))).alias("sig"),
    )
    classes = lines.groupBy("k1", "k2").agg(F.min("line").alias("first"), *[F.any_value(c).alias(c) for c in ("n", "prefix", "sig")])
    classes = stored(classes.select("first", "n", "prefix", "sig"))

    entries = _entries(classes).select("token", F.struct("first", "n", "at", "sig").alias("own"))
    salts = _salts(F.col("token"), counts)
    order = Window.partitionBy("token", F.pmod(F.xxhash64("own.first"), salts)).orderBy("own").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hubs = {f"hub{k}": F.nth_value("own", k + 1).over(order) for k in range(HUBS)}
    near = [F.expr(f"CASE WHEN {_may_link(percent, 'own', h)} AND {h}.first < own.first THEN {h}.first END") for h in hubs]
    met = entries.select("token", "own", F.row_number().over(order).alias("place"), *[c.alias(h) for h, c in hubs.items()])
    met = met.select("token", "own", F.array_compact(F.array(*near)).alias("near"), ((F.col("place") > HUBS) | (salts > 1)).alias("deep"))
    met = stored(met.where("deep OR SIZE(near) > 0"))
    pairs = stored(met.select(F.col("own.first").alias("x"), F.explode("near").alias("y")).distinct())
    settled = stored(_matched(pairs, rows, percent).select(F.col("x").alias("first")))

    deep = met.where("deep").select("token", "own.*").join(settled.withColumn("settled", F.lit(True)), "first", "left")
    deep = deep.withColumn("index", F.expr(f"at <= n - CEIL({2 * percent} * n / {100 + percent}D)"))
    may = F.expr(
        "a.token = b.token AND " + _may_link(percent, "a", "b") + " AND IF(b.index, b.first < a.first, a.n < b.n) "
        "AND IF(b.first < a.first, a.settled, b.settled) IS NULL"
    )
    found = deep.where("index").alias("a").join(deep.alias("b"), may)
    found = found.select(F.greatest("a.first", "b.first").alias("x"), F.least("a.first", "b.first").alias("y"))
    rest = stored(found.distinct().join(pairs, ["x", "y"], "left_anti"))
    more = stored(_matched(rest, rows, percent).select(F.col("x").alias("first")))
    return classes.select("first").join(settled.union(more), "first", "left_anti").select("first.*")


def dedup_lines(docs: DataFrame, percent: int = PERCENT, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the lines that match an earlier one; n_lines and n_removed are added."""
    held = Carried(docs, id=id, text=text)
    # an id that is of one row needs no hash of the text beside it
    repeated = not held.df.groupBy("id").count().where("count > 1").isEmpty()
    whole = held.df.withColumns({"text": F.col("text").cast("string"), "dh": F.xxhash64("text") if repeated else F.lit(0).cast("bigint")})
    rows = whole.select("id", "text", "dh")
    stay = kept_lines(rows, percent).groupBy("id", "dh").agg(F.collect_list("no").alias("stay"))
    stay = stay.select(F.col("id").alias("sid"), F.col("dh").alias("sdh"), "stay")
    joined = whole.join(stay, F.col("id").eqNullSafe(F.col("sid")) & (F.col("dh") == F.col("sdh")), "left")
    lines = F.split("text", "\n")
    blank = F.filter(F.sequence(F.lit(0), F.size("lines") - 1), lambda i: ~F.rlike(F.get("lines", i), F.lit(WORD)))
    out = joined.withColumn("lines", lines).withColumn("places", F.array_sort(F.concat(F.coalesce("stay", F.array().cast("array<int>")), blank)))
    out = out.withColumns(
        {
            "cleaned": F.array_join(F.transform("places", lambda i: F.get("lines", i)), "\n"),
            "n_lines": F.coalesce(F.when(F.col("text").isNotNull(), F.size("lines")), F.lit(0)).cast("bigint"),
        }
    ).withColumn("n_removed", F.when(F.col("text").isNotNull(), F.col("n_lines") - F.size("places")).otherwise(F.lit(0)).cast("bigint"))
    return held.back(out, {"text": "cleaned"}, ["n_lines", "n_removed"])


def oracle(percent: int = PERCENT, table: str = "documents", columns: str = "doc_id, n_lines, n_removed, text") -> str:
    """The same for DuckDB; its prefix filter puts long words first, since any common order serves."""
    words = r"list_sort(list_distinct(regexp_extract_all(lower(line), '[^\x20\x09-\x0D]+')))"
    return rf"""
WITH docs_ AS (SELECT *, string_split(text, chr(10)) AS lines_ FROM {table}),
lines_ AS MATERIALIZED (SELECT doc_id AS id, no - 1 AS no, {words} AS w FROM (SELECT doc_id, unnest(lines_) AS line, unnest(range(1, len(lines_) + 1)) AS no FROM docs_)),
class_ AS MATERIALIZED (SELECT w, len(w) AS n, min((id, no)) AS first, row_number() OVER (ORDER BY min((id, no))) AS k FROM lines_ WHERE len(w) > 0 GROUP BY w),
entry_ AS MATERIALIZED (SELECT k, n, w, unnest(list_transform(list_sort(list_transform(w, lambda x: (-len(x), x))), lambda x: x[2])[1:n - ceil(n * {percent} / 100.0)::BIGINT + 1]) AS t FROM class_),
gone_ AS (SELECT DISTINCT a.k FROM entry_ a JOIN entry_ b ON a.t = b.t AND b.k < a.k AND 100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n)
  WHERE len(list_intersect(a.w, b.w)) * 100 >= {percent} * (a.n + b.n - len(list_intersect(a.w, b.w)))),
stay_ AS MATERIALIZED (SELECT first[1] AS id, first[2] AS no FROM class_ WHERE k NOT IN (SELECT k FROM gone_) UNION ALL SELECT id, no FROM lines_ WHERE len(w) = 0),
text_ AS (SELECT id, string_agg(line, chr(10) ORDER BY no) AS cleaned, count(*) AS kept FROM (SELECT s.id, s.no, d.lines_[s.no + 1] AS line FROM stay_ s JOIN docs_ d ON d.doc_id = s.id) GROUP BY id)
SELECT {columns} FROM (SELECT d.* EXCLUDE (text, lines_), coalesce(cleaned, '') AS text, len(lines_) AS n_lines, len(lines_) - coalesce(kept, 0) AS n_removed FROM docs_ d LEFT JOIN text_ ON id = doc_id)
"""
