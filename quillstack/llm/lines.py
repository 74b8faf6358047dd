"""Line-first cleaning: rules judge every line, failed lines go, then documents that lost too much.

Spark functions only; one pass over the texts and no shuffle. Null texts are empty texts, a null
doc_id stays null, repeated rows are judged each for itself, other columns are ignored. An empty
text has no words, fails the base rule and loses nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstack.llm.common import SPACE, WORD, body

#: Share of its characters a document may lose to the line rules.
MAX_LOST = 0.5
#: Separators that make a line navigation.
NAVIGATION = r"^(?:[^|]*+\|){3}|^(?:[^»]*+»){2}|^(?:[^>]*+ > ){2}"
BOILERPLATE = (
    r"(?i)\b(?:all rights reserved|terms of (?:use|service)|privacy policy|cookie policy|enable javascript|"
    r"lorem ipsum|click here|subscribe to our|skip to (?:main )?content|spdx-license-identifier)\b"
)
#: Lines with upper-case letters and no lower-case ones; scripts without case and numbers are not shouted.
SHOUTED = r"^[^\p{Ll}]*$"
LOUD = r"\p{Lu}"
SYMBOLS = r"[#*$%&|<>]"
#: Symbols per word from which a line is noise.
SYMBOL_RATE = 0.5


def line_fault(line: Column) -> Column:
    """Name of the first rule a line with words breaks, else null."""
    words = F.regexp_count(line, F.lit(WORD))
    return (
        F.when(F.regexp_count(line, F.lit(SYMBOLS)) > SYMBOL_RATE * words, "punctuation")
        .when(line.rlike(NAVIGATION), "navigation")
        .when(line.rlike(LOUD) & line.rlike(SHOUTED) & (words >= 3), "shouting")
        .when(line.rlike(BOILERPLATE), "boilerplate")
    )


def judge(docs: DataFrame, max_lost: float = MAX_LOST) -> DataFrame:
    """`doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    lost_share, cleaned` of every row of `docs (doc_id, text)`; `cleaned` holds the kept lines.
    """
    split = docs.select("doc_id", body().alias("text")).select(
        "doc_id",
        F.array_remove(F.split("text", SPACE + "+"), "").alias("words"),
        (F.length("text") - F.regexp_count("text", F.lit(SPACE))).cast("bigint").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD)).alias("lines"),
    )
    hashed = split.select(
        "doc_id", "word_chars", "n_symbols", "lines",
        F.size("words").cast("bigint").alias("n_words"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("h"),
        F.filter("lines", lambda x: line_fault(x).isNull()).alias("good"),
    )
    window = lambda i: F.xxhash64(F.get("h", i), F.get("h", i + 1), F.get("h", i + 2))
    none = F.expr("cast(array() as array<bigint>)")
    grams = hashed.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "good",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.length(F.array_join("lines", "")).alias("had"),
        F.when(
            F.col("n_words") >= 3, F.transform(F.sequence(F.lit(0), F.col("n_words").cast("int") - 3), window)
        ).otherwise(none).alias("grams"),
    )
    counted = repeated_words(grams)
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    lost = 1 - F.length(F.array_join("good", "")) / F.greatest(F.col("had"), F.lit(1))
    lost = F.when(F.col("had") == 0, 0.0).otherwise(lost)
    judged = counted.withColumn("base_failed", base_failed).withColumn("lost_share", lost)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.col("lost_share") <= max_lost)).alias("kept"),
        "lost_share",
        F.array_join("good", "\n").alias("cleaned"),
    )


def repeated_words(df: DataFrame) -> DataFrame:
    """Adds `n_repeat_words`: words inside windows whose hash occurs twice or more in `grams`.

    Equal windows stand side by side once (hash, position) pairs are sorted, and each repeated
    window adds its words that no later one covers, so the work is that of one sort.
    """
    pairs = F.sort_array(F.transform("grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    none = F.expr("cast(array() as array<struct<g:bigint,i:int>>)")
    has_twin = F.size(F.array_distinct("grams")) < F.size("grams")
    twin = lambda x, k: (F.get("pairs", k - 1)["g"] == x["g"]) | (F.get("pairs", k + 1)["g"] == x["g"])
    twins = F.filter("pairs", lambda x, k: F.coalesce(twin(x, k), F.lit(False)))
    width = lambda p, k: F.least(F.lit(3), F.coalesce(F.get("marks", k + 1) - p, F.lit(3)))
    return (
        df.withColumn("pairs", F.when(has_twin, pairs).otherwise(none))
        .withColumn("marks", F.sort_array(F.transform(twins, lambda x: x["i"])))
        .withColumn("widths", F.transform("marks", width))
        .withColumn("n_repeat_words", F.aggregate("widths", F.lit(0).cast("bigint"), lambda a, w: a + w))
    )


SQL = r"""
with t as (select doc_id, coalesce(text, '') as text, row_number() over () as rid from documents),
w as (
  select rid, doc_id, text, list_filter(regexp_split_to_array(text, '[ \t-\r]+'), lambda x: x <> '') as words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \t-\r]')) as lines
  from t),
v as (select rid, unnest(words) as x, generate_subscripts(words, 1) as i from w),
g as (
  select * from (
    select rid, i, x || ' ' || lead(x, 1) over o || ' ' || lead(x, 2) over o as gram from v
    window o as (partition by rid order by i))
  where gram is not null),
twice as (select rid, gram from g group by rid, gram having count(*) > 1),
covered as (select rid, count(distinct i + k) as n_repeat_words from g join twice using (rid, gram),
  (values (0), (1), (2)) as o(k) group by rid),
good as (
  select rid, list_filter(lines, lambda x: not (
      len(regexp_extract_all(x, '[#*$%&|<>]')) > 0.5 * len(regexp_extract_all(x, '[^ \t-\r]+'))
      or regexp_matches(x, '^([^|]*\|){3}|^([^»]*»){2}|^([^>]* > ){2}')
      or (regexp_matches(x, '\p{Lu}') and regexp_matches(x, '^[^\p{Ll}]*$') and len(regexp_extract_all(x, '[^ \t-\r]+')) >= 3)
      or regexp_matches(x, '(?i)\b(all rights reserved|terms of (use|service)|privacy policy|cookie policy|enable javascript|lorem ipsum|click here|subscribe to our|skip to (main )?content|spdx-license-identifier)\b')
    )) as good
  from w),
m as (
  select doc_id, len(words)::bigint as n_words,
    list_sum(list_transform(words, lambda x: length(x)))::bigint as word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols,
    (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
    coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
    coalesce(list_sum(list_transform(lines, lambda x: length(x))), 0) as had,
    coalesce(list_sum(list_transform(good, lambda x: length(x))), 0) as has
  from w left join covered using (rid) join good using (rid))
select doc_id, n_words, coalesce(word_chars, 0) as word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
  not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and (had = 0 or 1 - has / had <= 0.5) as kept
from m
"""


def query(docs: DataFrame) -> DataFrame:
    return judge(docs).drop("lost_share", "cleaned")
