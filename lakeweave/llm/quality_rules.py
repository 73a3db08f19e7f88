"""Quality rules: base counts, and distribution divergence from language references, in SQL expressions only.

A document's character-class histogram and its histogram of common words are compared with fixed
references for each language by the Jensen-Shannon distance (base 2, the divergence's square root), and
the nearest reference counts, so that a wrong or mixed language tag doesn't matter. A document is rejected if
its classes are farther than ``far_classes`` from every reference, or its common words farther than
``far_words``: a text without a single common word is at least 0.319 from every reference, running text about
0.14. (Words count as they stand: lower-casing them and stripping punctuation brought lists of words nearer to
the references than prose moved.) Guards: classes are judged from ``least_chars`` characters and words from
``least_words`` words on, both only in texts that are mostly of the references' script.

Repeated five-word windows are found inside the row: window hashes are compared with their distinct
values, and only rows with repeats sort them. Nothing is shuffled.

Cases: a null text is empty: all counts are 0 and the base fails. A text without spaces is one word. Equal
rows get equal results. An empty table gives no rows. Null ids stay null. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeweave.llm.common import WS_CLASS, spread

#: Shares of lower-case vowels, other lower-case letters, capitals, digits, white space,
#: punctuation, symbols and characters beyond ASCII in running text.
CLASS_REFERENCES = {
    "en": (0.30, 0.46, 0.03, 0.008, 0.165, 0.032, 0.002, 0.003),
    "de": (0.28, 0.47, 0.055, 0.008, 0.14, 0.03, 0.002, 0.015),
    "fr": (0.33, 0.40, 0.025, 0.008, 0.16, 0.035, 0.002, 0.04),
    "es": (0.36, 0.40, 0.025, 0.008, 0.16, 0.025, 0.002, 0.02),
}
#: Common words and their shares of all words.
WORD_REFERENCES = {
    "en": {"the": 0.06, "of": 0.03, "and": 0.028, "to": 0.026, "in": 0.021, "is": 0.01, "that": 0.01, "for": 0.01, "was": 0.008, "it": 0.008, "with": 0.007, "on": 0.007},
    "de": {"die": 0.033, "der": 0.033, "und": 0.027, "in": 0.017, "das": 0.012, "den": 0.012, "zu": 0.011, "mit": 0.01, "von": 0.01, "ein": 0.008, "ist": 0.008, "nicht": 0.008},
    "fr": {"de": 0.045, "la": 0.03, "le": 0.025, "et": 0.024, "les": 0.022, "des": 0.018, "en": 0.015, "un": 0.011, "une": 0.01, "que": 0.01, "est": 0.01, "pour": 0.008},
    "es": {"de": 0.06, "la": 0.04, "que": 0.03, "el": 0.03, "en": 0.027, "y": 0.026, "los": 0.017, "las": 0.011, "del": 0.011, "un": 0.01, "se": 0.01, "por": 0.009},
}
#: Symbols whose characters are counted.
SYMBOLS = "#*$%&|<>"
PUNCTUATION = ".,;:!?'\"()-"
CLASSES = "vcUdspy"  # marks of the seven ASCII classes, in the order of CLASS_REFERENCES


def class_marks() -> tuple[str, str]:
    """ASCII characters and the mark of each one's class."""
    chars = [chr(c) for c in range(1, 128)]
    mark = lambda c: "v" if c in "aeiou" else "c" if c.islower() else "U" if c.isupper() else "d" if c.isdigit() else "s" if c.isspace() else "p" if c in PUNCTUATION else "y"
    return "".join(chars), "".join(map(mark, chars))


def _quote(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def nearest_sql(histogram: str, references: list[list[float]]) -> str:
    """SQL of the least Jensen-Shannon distance between an array of shares and the references."""
    part = "CASE WHEN {0} > 0 THEN {0} * log2(2 * {0} / (p + q)) ELSE 0D END"
    refs = ", ".join("array(" + ", ".join(f"{x!r}D" for x in r) + ")" for r in references)
    return f"sqrt(greatest(0D, array_min(transform(array({refs}), r -> aggregate(zip_with({histogram}, r, (p, q) -> ({part.format('p')} + {part.format('q')}) / 2), 0D, (a, x) -> a + x)))))"


def class_table() -> list[list[float]]:
    return [[x / sum(r) for x in r] for r in CLASS_REFERENCES.values()]


def common_words() -> list[str]:
    return sorted({w for r in WORD_REFERENCES.values() for w in r})


def word_table() -> list[list[float]]:
    """Shares of all common words (0 where a language lacks one) and of the rest."""
    return [[*(r.get(w, 0.0) for w in common_words()), 1 - sum(r.values())] for r in WORD_REFERENCES.values()]


def quality_rules(docs: DataFrame, far_classes: float = 0.35, far_words: float = 0.30, least_chars: int = 200, least_words: int = 60, carry: list[str] | None = None) -> DataFrame:
    """Base counts and verdicts for docs (doc_id, text); ``carry`` names the columns that go along (doc_id)."""
    own = F.struct(*(F.col(f"`{c}`") for c in carry)) if carry else F.struct(F.col("doc_id").cast("long").alias("doc_id"))
    rows = spread(docs.select(own.alias("own"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")))
    chars, marks = class_marks()
    bare, space = "text", WS_CLASS.replace("\\", "\\\\")  # SQL literals unescape backslashes
    for c in SYMBOLS:
        bare = f"replace({bare}, '{c}', '')"
    words = rows.selectExpr(
        "own",
        f"filter(split(text, '{space}+'), w -> w <> '') AS words",
        "length(text) AS n_chars",
        f"length(text) - length({bare}) AS n_symbols",
        f"filter(split(text, '\\n'), l -> l RLIKE '[^{space[1:]}') AS lines",
        f"translate(text, {_quote(chars)}, {_quote(marks)}) AS marked",
    )
    gram = ", ".join(f"words[i + {k}]" for k in range(5))
    used = "(" + ", ".join(map(_quote, common_words())) + ")"
    counted = words.selectExpr(
        "own",
        "CAST(size(words) AS LONG) AS n_words",
        "CAST(length(array_join(words, '')) AS LONG) AS word_chars",
        "CAST(n_symbols AS LONG) AS n_symbols",
        "CAST(size(lines) - size(array_distinct(lines)) AS LONG) AS n_dup_lines",
        "n_chars",
        f"transform(array({', '.join(map(_quote, CLASSES))}), m -> length(marked) - length(replace(marked, m, ''))) AS in_class",
        f"concat(' ', array_join(filter(words, w -> w IN {used}), '  '), ' ') AS known",
        f"CASE WHEN size(words) < 6 THEN array() ELSE transform(sequence(0, size(words) - 5), i -> xxhash64({gram})) END AS windows",
    )
    sorted_ = counted.selectExpr(
        "own", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_chars",
        "CASE WHEN n_chars = 0 THEN NULL ELSE transform(concat(in_class, array(n_chars - aggregate(in_class, 0, (a, x) -> a + x))), x -> CAST(x AS DOUBLE) / n_chars) END AS classes",
        f"transform(array({', '.join(map(_quote, common_words()))}), w -> (length(known) - length(replace(known, concat(' ', w, ' '), ''))) / (length(w) + 2)) AS common",
        "CASE WHEN size(windows) = size(array_distinct(windows)) THEN array() ELSE sort_array(transform(windows, (h, i) -> struct(h, i))) END AS ordered",
    )
    placed = sorted_.withColumn("places", F.expr("sort_array(transform(filter(ordered, (x, i) -> x.h <=> get(ordered, i - 1).h OR x.h <=> get(ordered, i + 1).h), x -> x.i))")).drop("ordered")
    judged = placed.selectExpr(
        "own", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_chars", "classes",
        "CAST(aggregate(zip_with(places, slice(places, 2, greatest(1, size(places))), (a, b) -> least(5, coalesce(b - a, 5))), 0, (a, x) -> a + x) AS LONG) AS n_repeat_words",
        "CASE WHEN n_words = 0 THEN NULL ELSE transform(concat(common, array(n_words - aggregate(common, 0D, (a, x) -> a + x))), x -> x / n_words) END AS shares",
    )
    far = judged.selectExpr(
        "own", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed",
        f"CASE WHEN n_chars >= {least_chars} AND element_at(classes, -1) <= 0.5D THEN {nearest_sql('classes', class_table())} END AS class_distance",
        f"CASE WHEN n_words >= {least_words} AND element_at(classes, -1) <= 0.5D THEN {nearest_sql('shares', word_table())} END AS word_distance",
    )
    kept = F.expr(f"NOT base_failed AND coalesce(class_distance, 0D) <= {far_classes}D AND coalesce(word_distance, 0D) <= {far_words}D")
    if carry:
        return far.select("own", kept.alias("kept"))
    return far.withColumn("kept", kept).select("own.doc_id", *far.columns[1:], "kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of docs, all their columns, that the rules keep."""
    verdicts = quality_rules(docs, carry=docs.columns).withColumn("at", F.monotonically_increasing_id())
    # The row number keeps the filter above the projections: pushed below, it would repeat their expressions many times over.
    return verdicts.where("kept AND at >= 0").select("own.*")
