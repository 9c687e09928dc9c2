"""Quality rules whose cutoffs come from the data: quantile sketches per language and source.

Signals of a text are rates per thousand, so whole numbers from 0 up:
symbols per word character, words in repeated 3-word windows, repeated lines beyond the first (a short
text may well have one), and word length.

The sketch of a signal is a relative-error one (DDSketch: Masson, Rim and Lee, 2019), kept per (language, source): a
value x lies in bucket ceil(log_g x) with g = (1 + ERROR) / (1 - ERROR), zero in one of its own, and a bucket stands for
2 g^i / (g + 1). Any quantile read off it is within ERROR (one percent) of the value it is an estimate of, whatever the
distribution; up to about 50 whole numbers have buckets of their own. Such sketches merge by adding counts, in any
order, so map tasks combine before the shuffle, a hot source is no hot key, and results are the same in every run.
A sketch has some 700 buckets at the most. Languages and the whole table have the merged sketches of their sources.

A cutoff is the median plus `spread` times the distance from the lower decile to the median. It uses the lower half only,
so that junk in up to half of a source cannot lift it. A distance counts as `least` at the least: where most
texts have none of something (both quantiles are zero), so small a rate says nothing. Word length has a cutoff on either
side. Quantiles of a source lean on its language's, and those on the table's, by n to SHRINK, n being the
rows seen: a source of few rows has nearly its language's cutoffs, and there is no size at which they jump.
Rows are then joined with the cutoffs of their group.

Defined results: null text has no words (and fails the base rules); null lang or source is a group
of its own; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkweft.llm.common import SPACES, WORD, materialise, text_of

SYMBOLS = "#*$%&|<>"
#: signal: (spread, least distance, sides)
RULES = {
    "symbol_rate": (8, 5, "upper"),
    "repeat_rate": (6, 60, "upper"),
    "dup_line_rate": (8, 30, "upper"),
    "word_length": (6, 50, "both"),
}
#: Relative error of a quantile, and the rows at which a group's own quantiles weigh as much as those of what it is part of.
ERROR, SHRINK = 0.01, 50
_G = (1 + ERROR) / (1 - ERROR)
#: Expressions that Spark's SQL and others have alike.
_BUCKET = f"case when {{x}} = 0 then 0 else 1 + cast(ceil(ln({{x}}) / {math.log(_G)!r} - 1e-9) as bigint) end"
_VALUE = f"case when {{b}} = 0 then 0.0 else round(2 * pow(cast({_G!r} as double), {{b}} - 1) / {_G + 1!r}, 6) end"


def base_signals(docs: DataFrame, keep: tuple[str, ...] = ("doc_id", "lang", "source"), text_col: str = "text") -> DataFrame:
    """The columns in `keep` (those that docs has) and n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words.

    A text's 3-word windows are hashed to 64 bits; only where two hashes of a text agree are its
    windows sorted, by hash and then by the words themselves, so the count is exact. The work on a
    text of n words is O(n log n).
    """
    text = text_of(text_col)
    d = docs.select(*keep, text.alias("_t"), F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("_w"))
    d = d.select(
        *keep,
        "_w",
        F.size("_w").alias("_n"),
        F.length(F.translate("_t", SPACES, "")).alias("_chars"),
        (F.length("_t") - F.length(F.translate("_t", SYMBOLS, ""))).alias("_symbols"),
        F.filter(F.split("_t", "\n", -1), lambda x: x.rlike(WORD)).alias("_lines"),
        F.expr("if(size(_w) < 3, array(), transform(sequence(0, greatest(size(_w) - 3, 0)), i -> xxhash64(_w[i], _w[i + 1], _w[i + 2])))").alias("_h"),
    )
    d = d.select(
        *keep,
        "_n",
        "_chars",
        "_symbols",
        F.size("_lines").alias("_n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("_dup_lines"),
        F.expr("""if(size(_h) = size(array_distinct(_h)), cast(array() as array<struct<h: bigint, s: string, i: int>>),
                     array_sort(transform(_h, (h, i) -> named_struct('h', h, 's', concat_ws(' ', _w[i], _w[i + 1], _w[i + 2]), 'i', i))))""").alias("_s"),
    )
    twice = """filter(transform(_s, (x, k) -> if((k > 0 and _s[greatest(k - 1, 0)].h = x.h and _s[greatest(k - 1, 0)].s = x.s)
                  or (k < size(_s) - 1 and _s[least(k + 1, size(_s) - 1)].h = x.h and _s[least(k + 1, size(_s) - 1)].s = x.s), x.i, -1)), i -> i >= 0)"""
    d = d.select(*keep, "_n", "_chars", "_symbols", "_n_lines", "_dup_lines", F.sort_array(F.expr(twice)).alias("_at"))
    covered = "aggregate(transform(_at, (x, k) -> if(k = 0, 3, least(3, x - _at[greatest(k - 1, 0)]))), 0, (a, b) -> a + b)"
    names = {"_n": "n_words", "_chars": "word_chars", "_symbols": "n_symbols", "_n_lines": "n_lines", "_dup_lines": "n_dup_lines"}
    return d.select(*keep, *(F.col(a).cast("long").alias(b) for a, b in names.items()), F.expr(covered).cast("long").alias("n_repeat_words"))


def with_rates(signals: DataFrame) -> DataFrame:
    """base_failed and the four signals in whole numbers."""
    rate = lambda part, of: F.expr(f"({part} * 1000) div greatest({of}, 1)")
    return signals.withColumns({
        "base_failed": F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words"),
        "symbol_rate": rate("n_symbols", "word_chars"),
        "repeat_rate": rate("n_repeat_words", "n_words"),
        "dup_line_rate": rate("greatest(n_dup_lines - 1, 0)", "n_lines"),
        "word_length": F.expr("(word_chars * 100) div greatest(n_words, 1)"),
    })


def sketches(rates: DataFrame) -> DataFrame:
    """lang, source, signal, bucket, rows: the mergeable sketches of the rows that pass the base rules.

    Each map task sends at most one row a bucket, so the shuffle is bounded by groups and buckets, not by rows.
    """
    long = rates.filter("not base_failed").select(
        "lang", "source",
        F.explode(F.array(*(F.struct(F.lit(s).alias("signal"), F.expr(_BUCKET.format(x=s)).alias("bucket")) for s in RULES))).alias("x"),
    )
    return long.groupBy("lang", "source", F.col("x.signal").alias("signal"), F.col("x.bucket").alias("bucket")).agg(F.count(F.lit(1)).alias("rows"))


def quantiles(found: DataFrame, keys: list[str]) -> DataFrame:
    """n (rows), q50 and q10 (median and lower decile) of each group's merged sketch."""
    merged = found.groupBy(*keys, "signal", "bucket").agg(F.sum("rows").alias("rows"))
    hist = merged.groupBy(*keys, "signal").agg(F.sum("rows").alias("n"), F.array_sort(F.collect_list(F.struct("bucket", "rows"))).alias("h"))

    def at(part: str) -> str:
        return f"aggregate(h, named_struct('seen', 0L, 'at', cast(null as bigint)), (a, x) -> named_struct('seen', a.seen + x.rows, 'at', coalesce(a.at, if({part} * (a.seen + x.rows) >= n, x.bucket, cast(null as bigint)))), a -> a.at)"

    picked = hist.select(*keys, "signal", "n", F.expr(at("2")).alias("b50"), F.expr(at("10")).alias("b10"))
    return picked.select(*keys, "signal", "n", F.expr(_VALUE.format(b="b50")).cast("double").alias("q50"), F.expr(_VALUE.format(b="b10")).cast("double").alias("q10"))


def cutoffs(found: DataFrame, shrink: int = SHRINK) -> DataFrame:
    """lang, source and low_/high_ of each signal; quantiles lean on the language's, and those on the table's."""
    own, lang, whole = quantiles(found, ["lang", "source"]), quantiles(found, ["lang"]), quantiles(found, [])
    lean = lambda q: F.expr(f"(o.n * o.{q} + {shrink} * ((l.n * l.{q} + {shrink} * w.{q}) / (l.n + {shrink}))) / (o.n + {shrink})")
    # Joins of tables with a row for each source: null keys match.
    joined = (
        own.alias("o")
        .join(lang.alias("l"), F.col("o.lang").eqNullSafe(F.col("l.lang")) & (F.col("o.signal") == F.col("l.signal")))
        .join(whole.alias("w"), F.col("o.signal") == F.col("w.signal"))
        .select(F.col("o.lang").alias("lang"), F.col("o.source").alias("source"), F.col("o.signal").alias("signal"), lean("q50").alias("q50"), lean("q10").alias("q10"))
    )
    aggs = []
    for s, (spread, least, sides) in RULES.items():
        is_s = F.col("signal") == s
        reach = spread * F.greatest(F.col("q50") - F.col("q10"), F.lit(float(least)))
        aggs.append(F.max(F.when(is_s, F.round(F.col("q50") + reach, 6))).alias(f"high_{s}"))
        if sides == "both":
            aggs.append(F.max(F.when(is_s, F.round(F.col("q50") - reach, 6))).alias(f"low_{s}"))
    return joined.groupBy("lang", "source").agg(*aggs)


def judge(rates: DataFrame, limits: DataFrame) -> DataFrame:
    """rates joined with the cutoffs of their group; kept is false for a base failure or a signal beyond its cutoff."""
    limits = limits.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), *[c for c in limits.columns if c not in ("lang", "source")])
    joined = rates.join(limits, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    ok = F.lit(True)
    for s, (*_, sides) in RULES.items():
        ok = ok & F.coalesce(F.col(s) <= F.col(f"high_{s}"), F.lit(True))
        if sides == "both":
            ok = ok & F.coalesce(F.col(s) >= F.col(f"low_{s}"), F.lit(True))
    return joined.withColumn("kept", ~F.col("base_failed") & ok).drop("_lang", "_source")


def quality_rules(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """`keep`, lang, source, the base signals, rates, cutoffs, base_failed and kept for every row of docs.

    Signals are computed once and written to the shared folder (a few numbers a row, no texts).
    """
    columns = tuple(dict.fromkeys((*keep, "lang", "source")))
    extra = [c for c in ("lang", "source") if c not in docs.columns]
    docs = docs.withColumns({c: F.lit(None).cast("string") for c in extra}) if extra else docs
    rates = materialise(with_rates(base_signals(docs, columns, text_col)), "signals")
    return judge(rates, cutoffs(sketches(rates)))


#: The same in DuckDB, from the same table of rules.
_BUCKETS = ", ".join(f"('{s}', {_BUCKET.format(x=s)})" for s in RULES)
_LIMIT_ROWS = ", ".join(f"('{s}', {spread}, {least}, {str(sides == 'both').lower()})" for s, (spread, least, sides) in RULES.items())


def _sql_quantiles(name: str, keys: str) -> str:
    on = f"{keys}, " if keys else ""
    return f"""
    {name} AS (
        SELECT {on}signal, n, ({_VALUE.format(b="b50")})::DOUBLE AS q50, ({_VALUE.format(b="b10")})::DOUBLE AS q10 FROM (
            SELECT {on}signal, max(n) AS n, min(bucket) FILTER (2 * seen >= n) AS b50, min(bucket) FILTER (10 * seen >= n) AS b10
            FROM (SELECT {on}signal, bucket, sum(rows) OVER (PARTITION BY {on}signal ORDER BY bucket) AS seen, sum(rows) OVER (PARTITION BY {on}signal) AS n
                  FROM (SELECT {on}signal, bucket, sum(rows) AS rows FROM hist GROUP BY ALL))
            GROUP BY ALL))"""


_LEAN = f"(o.n * o.{{q}} + {SHRINK} * ((l.n * l.{{q}} + {SHRINK} * w.{{q}}) / (l.n + {SHRINK}))) / (o.n + {SHRINK}) AS {{q}}"
QUALITY_SQL = f"""
WITH words AS (
    SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
windows AS (
    SELECT r, unnest(range(1, len(w) - 1)) AS i, unnest(w[1:len(w) - 2]) AS w1, unnest(w[2:len(w) - 1]) AS w2, unnest(w[3:len(w)]) AS w3 FROM words WHERE len(w) >= 3),
counted AS (
    SELECT r, i, count(*) OVER (PARTITION BY r, w1, w2, w3) AS c FROM windows),
covered AS (
    SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM counted, (VALUES (0), (1), (2)) AS o(k) WHERE c > 1 GROUP BY r),
lines AS (
    SELECT r, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM words),
base AS (
    SELECT doc_id, lang, source, len(w)::BIGINT AS n_words, length(translate(t, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), ''))::BIGINT AS word_chars,
           (length(t) - length(translate(t, '{SYMBOLS}', '')))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines,
           (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
    FROM words JOIN lines USING (r) LEFT JOIN covered USING (r)),
rates AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, n_symbols * 1000 // greatest(word_chars, 1) AS symbol_rate,
           n_repeat_words * 1000 // greatest(n_words, 1) AS repeat_rate, greatest(n_dup_lines - 1, 0) * 1000 // greatest(n_lines, 1) AS dup_line_rate,
           word_chars * 100 // greatest(n_words, 1) AS word_length
    FROM base),
hist AS (
    SELECT lang, source, signal, bucket, count(*) AS rows FROM rates, LATERAL (VALUES {_BUCKETS}) AS x(signal, bucket) WHERE NOT base_failed GROUP BY ALL),
{_sql_quantiles("own", "lang, source")}, {_sql_quantiles("by_lang", "lang")}, {_sql_quantiles("whole", "")},
picked AS (
    SELECT o.lang, o.source, o.signal, {_LEAN.format(q="q50")}, {_LEAN.format(q="q10")}
    FROM own o JOIN by_lang l ON o.lang IS NOT DISTINCT FROM l.lang AND o.signal = l.signal JOIN whole w ON o.signal = w.signal),
limits AS (
    SELECT lang, source, signal, round(q50 + spread * greatest(q50 - q10, least_), 6) AS high,
           CASE WHEN both_ THEN round(q50 - spread * greatest(q50 - q10, least_), 6) END AS low
    FROM picked JOIN (VALUES {_LIMIT_ROWS}) AS x(signal, spread, least_, both_) USING (signal)),
wide AS (
    SELECT lang, source, {", ".join(f"max(high) FILTER (signal = '{s}') AS high_{s}, max(low) FILTER (signal = '{s}') AS low_{s}" for s in RULES)} FROM limits GROUP BY ALL)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {" AND ".join(f"coalesce({s} <= high_{s}, true) AND coalesce({s} >= low_{s}, true)" for s in RULES)} AS kept
FROM rates r LEFT JOIN wide x ON r.lang IS NOT DISTINCT FROM x.lang AND r.source IS NOT DISTINCT FROM x.source"""
