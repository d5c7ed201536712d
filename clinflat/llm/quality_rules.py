"""Quality rules whose thresholds come from the corpus, per language and source.

Each rule measures a share in thousandths. A sketch of a rule is its histogram over 0 to 1000:
sketches of parts add up to the sketch of the whole, its quantiles are exact to a thousandth and
do not depend on how rows are dealt. Thresholds are read from the sketches and joined to the
documents, which are then filtered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinflat.llm.common import checkpointed, text_of, words_of

WINDOW_WORDS = 5


def _in_array(value: Column, function) -> Column:
    """function(value), with value computed once however often function names it."""
    return F.transform(F.array(value), function)[0]


def _repeated_words(words: Column) -> Column:
    """Words that lie in windows of five words found twice or more in the text.

    Windows are hashed once. Only a text with a repeat sorts its windows with their places; the
    words covered are summed from the distances between successive repeated places.
    """

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            twice = F.filter(s, lambda x, i: (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"]))
            return F.sort_array(F.transform(twice, lambda x: x["i"]))

        return F.aggregate(
            _in_array(placed, places),
            F.struct(F.lit(0).alias("sum"), F.lit(-WINDOW_WORDS).alias("last")),
            lambda a, p: F.struct(
                (a["sum"] + F.least(F.lit(WINDOW_WORDS), p - a["last"])).alias("sum"), p.alias("last")
            ),
            lambda a: a["sum"],
        )

    def of(w: Column) -> Column:
        hashes = F.transform(
            F.sequence(F.lit(0), F.size(w) - WINDOW_WORDS),
            lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW_WORDS)]),
        )
        return _in_array(
            hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))
        )

    return F.when(F.size(words) <= WINDOW_WORDS, F.lit(0)).otherwise(_in_array(words, of))


def _measured(text: Column) -> Column:
    words = words_of(text)
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def counts(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.char_length(x)).alias("word_chars"),
            F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
            _in_array(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup"))).alias("lines"),
            _repeated_words(w).cast("long").alias("n_repeat_words"),
        )

    return _in_array(words, counts)


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document its counts and, in thousandths, the measures of the rules."""
    counted = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        _measured(text_of(text_col)).alias("m"),
    )

    def thousandths(part: str, whole: str) -> Column:
        share = F.col(f"m.{part}") * 1000 / F.greatest(F.col(f"m.{whole}"), F.lit(1))
        return F.least(F.floor(share), F.lit(1000)).cast("int")

    return counted.select(
        "doc_id",
        "lang",
        "source",
        F.col("m.n_words").alias("n_words"),
        F.col("m.word_chars").alias("word_chars"),
        F.col("m.n_symbols").alias("n_symbols"),
        F.col("m.lines.dup").cast("long").alias("n_dup_lines"),
        F.col("m.n_repeat_words").alias("n_repeat_words"),
        F.col("m.lines.n").cast("long").alias("n_lines"),
        thousandths("n_symbols", "word_chars").alias("symbols"),
        thousandths("lines.dup", "lines.n").alias("dup_lines"),
        thousandths("n_repeat_words", "n_words").alias("repeats"),
    )


#: Tolerance of a rule in thousandths: how far beyond its fence a value is still kept.
TOLERANCE = {"symbols": 50, "dup_lines": 350, "repeats": 200}
MIN_ROWS = 100


#: Measures with a spread of their own, as hundredths of doublings: how long words are, texts, and lines.
SPREAD = {"word_length": "word_chars / n_words", "length": "n_words", "line_length": "n_words / greatest(n_lines, 1)"}


def with_spread(measured: DataFrame) -> DataFrame:
    """measured with the SPREAD measures, null for a text without words."""
    return measured.withColumns(
        {
            name: F.when(F.col("n_words") > 0, F.round(100 * F.log2(F.expr(mean))).cast("int"))
            for name, mean in SPREAD.items()
        }
    )


def sketches(measured: DataFrame, names: Sequence[str] = tuple(TOLERANCE)) -> DataFrame:
    """Histograms (lang, source, rule, value, n): at most some thousand values for each rule and group."""
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("value")) for r in names]))
    one = measured.select("lang", "source", rules.alias("r")).select("lang", "source", "r.rule", "r.value")
    return one.where("value IS NOT NULL").groupBy("lang", "source", "rule", "value").agg(F.count(F.lit(1)).alias("n"))


def _quartiles(histograms: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (keys, rule, total, q1, q3) of the sketches, merged by the keys."""
    merged = histograms.groupBy(*keys, "rule", "value").agg(F.sum("n").alias("n"))
    by_rule = Window.partitionBy(*keys, "rule")
    placed = merged.select(
        "*",
        F.sum("n").over(by_rule.orderBy("value")).alias("upto"),
        F.sum("n").over(by_rule).alias("total"),
    )
    return placed.groupBy(*keys, "rule").agg(
        F.max("total").alias("total"),
        F.min(F.when(F.col("upto") * 4 >= F.col("total"), F.col("value"))).alias("q1"),
        F.min(F.when(F.col("upto") * 4 >= F.col("total") * 3, F.col("value"))).alias("q3"),
    )


def _tolerance() -> Column:
    return F.create_map(*[F.lit(x) for pair in TOLERANCE.items() for x in pair])[F.col("rule")]


def thresholds(histograms: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """Upper limit of each rule per language and source.

    The limit is the upper quartile plus three times the distance of the quartiles plus the
    rule's tolerance. A group of fewer than min_rows documents takes the sketch of its language,
    merged from all sources, and a language of fewer that of the whole corpus.
    """

    def limits(keys: list[str], name: str) -> DataFrame:
        limit = F.col("q3") + 3 * (F.col("q3") - F.col("q1")) + _tolerance()
        return _quartiles(histograms, keys).select(*keys, "rule", F.when(F.col("total") >= min_rows, limit).alias(name))

    own = limits(["lang", "source"], "own")
    of_lang = limits(["lang"], "of_lang")
    of_all = limits([], "of_all")
    everywhere = of_all.select("rule", F.coalesce("of_all", F.lit(1000)).alias("of_all"))
    merged = own.join(of_lang, ["lang", "rule"]).join(everywhere, "rule")
    return merged.groupBy("lang", "source").agg(
        *[
            F.max(F.when(F.col("rule") == r, F.coalesce("own", "of_lang", "of_all"))).alias(f"max_{r}")
            for r in TOLERANCE
        ]
    )


def fences(histograms: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """Per language and source the range (low_R, high_R) of each rule R, null where nothing bounds it.

    A range reaches three times the distance of the quartiles beyond them, for the shares a
    tolerance more and upwards alone. Shares are of junk: a group's limit is at most that of its
    language, so that a source full of junk does not raise its own, and the middle one of the
    limits of the language's sources, so that a large source does not do it either. Lengths
    differ between good sources, so a group's own range decides. A group without spread, or of
    fewer than min_rows documents, has the range of its language, a language of fewer that of
    the corpus.
    """
    reach = 3 * (F.col("q3") - F.col("q1")) + F.coalesce(_tolerance(), F.lit(0))
    share = F.col("rule").isin(*TOLERANCE)
    fair = F.col("total") >= min_rows

    def ranges(quartiles: DataFrame, keys: list[str], name: str, use: Column) -> DataFrame:
        return quartiles.select(
            *keys,
            "rule",
            F.when(fair & use & ~share, F.col("q1") - reach).alias(f"low_{name}"),
            F.when(fair & use, F.col("q3") + reach).alias(f"high_{name}"),
        )

    groups = _quartiles(histograms, ["lang", "source"])
    own = ranges(groups, ["lang", "source"], "own", share | (F.col("q3") > F.col("q1")))
    of_lang = ranges(_quartiles(histograms, ["lang"]), ["lang"], "lang", F.lit(True))
    # the middle one of the sources' limits on shares
    middle = own.where(share).groupBy("lang", "rule").agg(F.percentile("high_own", F.lit(0.5)).alias("high_middle"))
    of_all = ranges(_quartiles(histograms, []), [], "all", F.lit(True))
    merged = own.join(of_lang, ["lang", "rule"]).join(of_all, "rule").join(middle, ["lang", "rule"], "left")
    low = F.coalesce("low_own", "low_lang", "low_all")
    high = F.coalesce(F.when(share, F.least("high_own", "high_lang", "high_middle")), "high_own", "high_lang", "high_all")
    columns = []
    for r in (*TOLERANCE, *SPREAD):
        columns += [F.max(F.when(F.col("rule") == r, x)).alias(f"{n}_{r}") for n, x in (("low", low), ("high", high))]
    return merged.groupBy("lang", "source").agg(*columns)


def _failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def quality_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its counts, base_failed, kept and the limits that it met.

    docs has lang and source; nulls there are a group of their own. A null text has no words. A
    document with fewer than ten words, or with over a fifth of its words in repeats, fails the
    base; any other is dropped if one of its measures is above the limit of its language and
    source. Rows that repeat an id each get their verdict. Columns of other names are ignored.
    """
    measured = checkpointed(measures(docs, id_col, text_col))
    judged = measured.join(thresholds(sketches(measured)), ["lang", "source"])
    failed = _failed()
    above = F.lit(False)
    for rule in TOLERANCE:
        above = above | (F.col(rule) > F.col(f"max_{rule}"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & ~above).alias("kept"),
        *[F.col(f"max_{r}").cast("long").alias(f"max_{r}") for r in TOLERANCE],
    )


def typical(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, kept): as quality_verdicts, and kept only within the fences of all rules.

    quality_verdicts has its limits from its SQL; these rules come on top of it.
    """
    measured = checkpointed(with_spread(measures(docs, id_col, text_col)))
    limits = thresholds(sketches(measured)).join(fences(sketches(measured, (*TOLERANCE, *SPREAD))), ["lang", "source"])
    good = ~_failed()
    for rule in TOLERANCE:
        good = good & (F.col(rule) <= F.col(f"max_{rule}"))
    for rule in (*TOLERANCE, *SPREAD):
        value = F.col(rule)
        good = good & F.coalesce(value >= F.col(f"low_{rule}"), F.lit(True)) & F.coalesce(value <= F.col(f"high_{rule}"), F.lit(True))
    return measured.join(limits, ["lang", "source"]).select("doc_id", good.alias("kept"))


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fenced: bool = False) -> DataFrame:
    """The documents of docs whose verdict is kept, by `typical` if fenced; rows that repeat an id stay if one of them is kept."""
    verdicts = (typical if fenced else quality_verdicts)(docs, id_col, text_col)
    kept = verdicts.where("kept").select(F.col("doc_id").alias("_kept_id")).distinct()
    return docs.join(kept, F.col(id_col).eqNullSafe(F.col("_kept_id")), "left_semi")


SQL = r"""
WITH text AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
), split AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM text
), windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i:i + 4]) AS times
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM split WHERE len(w) >= 5)
), covered AS (
  SELECT doc_id, count(DISTINCT place) AS n
  FROM (SELECT doc_id, unnest(range(i, i + 5)) AS place FROM windows WHERE times > 1) GROUP BY doc_id
), m AS (
  SELECT s.doc_id, lang, source, len(w)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         len(l) AS n_lines
  FROM split s LEFT JOIN covered c ON c.doc_id = s.doc_id
), shares AS (
  SELECT lang, source, 'symbols' AS rule, 50 AS tolerance, least(n_symbols * 1000 // greatest(word_chars, 1), 1000) AS v FROM m
  UNION ALL SELECT lang, source, 'dup_lines', 350, least(n_dup_lines * 1000 // greatest(n_lines, 1), 1000) FROM m
  UNION ALL SELECT lang, source, 'repeats', 200, least(n_repeat_words * 1000 // greatest(n_words, 1), 1000) FROM m
), levels AS (
  SELECT 1 AS level, lang, source, rule, tolerance, v FROM shares
  UNION ALL SELECT 2, lang, '', rule, tolerance, v FROM shares
  UNION ALL SELECT 3, '', '', rule, tolerance, v FROM shares
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY level, lang, source, rule ORDER BY v) AS k,
         count(*) OVER (PARTITION BY level, lang, source, rule) AS n FROM levels
), limits AS (
  SELECT level, lang, source, rule, CASE WHEN max(n) >= 100 THEN
    min(v) FILTER (k * 4 >= n * 3) * 4 - 3 * min(v) FILTER (k * 4 >= n) + max(tolerance) END AS top
  FROM ranked GROUP BY ALL
), chosen AS (
  SELECT a.lang, a.source, a.rule, coalesce(a.top, b.top, c.top, 1000)::BIGINT AS top
  FROM limits a JOIN limits b ON b.level = 2 AND b.lang = a.lang AND b.rule = a.rule
  JOIN limits c ON c.level = 3 AND c.rule = a.rule WHERE a.level = 1
), wide AS (
  SELECT lang, source, max(top) FILTER (rule = 'symbols') AS max_symbols,
         max(top) FILTER (rule = 'dup_lines') AS max_dup_lines, max(top) FILTER (rule = 'repeats') AS max_repeats
  FROM chosen GROUP BY ALL
), failed AS (
  SELECT m.*, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND n_symbols * 1000 // greatest(word_chars, 1) <= max_symbols
         AND n_dup_lines * 1000 // greatest(n_lines, 1) <= max_dup_lines
         AND n_repeat_words * 1000 // greatest(n_words, 1) <= max_repeats AS kept,
       max_symbols, max_dup_lines, max_repeats
FROM failed f JOIN wide t ON t.lang = f.lang AND t.source = f.source
"""
