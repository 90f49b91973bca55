"""Quality rules: a table of thresholds compiled into one projection of Spark expressions.

``FEATURES`` are measured once a text, ``RULES`` compare them. Base features and the base verdict are
those of the contract; the further rules ask for what running prose shows in any language: no
flood of symbols or bars, few lines or word triples said again, words of common length and
a share of the commonest function words.

Null or blank text has no words: all counts 0, it fails. Each row is judged alone, so repeated rows
and null ids get their rows; an empty table gives an empty one. ``keep_good`` leaves all columns as they were, whatever their names.
Triples of words are compared by a 64-bit hash within one text; sorting them, not a map, finds those
found twice, so a very long text costs n log n.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentrisk.llm.common import SPACE_CLASS, let, unused, words

#: Common function words of the four languages.
STOP_WORDS = """
the of and to a in is that it for was on with as be by this are at from
der die und in den von zu das mit sich des für auf ist im ein nicht dem eine als
de la le et les des en un du une que est pour qui dans par au sur pas avec
de la que el en y los se del las un su por con no para una es al lo
""".split()


@dataclass(frozen=True)
class Rule:
    """Reject where ``feature`` is below ``least`` or above ``most``."""
    feature: str
    least: float | None = None
    most: float | None = None


RULES = [
    Rule("n_words", least=50),
    Rule("repeat_share", most=0.5),
    Rule("symbol_ratio", most=0.3),
    Rule("dup_line_share", most=0.5),
    Rule("word_length", least=2.0, most=12.0),
    Rule("stop_share", least=0.02),
]


def repeat_words(ws: Column) -> Column:
    """Words that lie in a 3-word window found twice or more."""
    def of(w):
        hashed = F.transform(F.slice(w, F.lit(1), F.size(w) - 2),
                             lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
        return let(hashed, covered)

    def covered(h):
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            let(F.sort_array(h), lambda s: let(said_again(s), lambda again: places(h, again))))

    def said_again(s):
        n = F.size(s) - 1
        return F.array_distinct(F.array_compact(F.zip_with(
            F.slice(s, F.lit(1), n), F.slice(s, F.lit(2), n), lambda x, y: F.when(x == y, x))))

    def places(h, again):
        # few values are looked up one by one, many are met by sorting: the same places either way
        few = F.filter(F.transform(h, lambda x, i: F.when(F.array_contains(again, x), i)), lambda i: i.isNotNull())
        many = let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), twice)
        return F.when(F.size(again) <= 32, let(few, span)).otherwise(many)

    def twice(s):
        n = F.size(s)
        last = F.struct(F.lit(None).cast("long").alias("h"), F.lit(None).cast("int").alias("i"))
        after = F.concat(F.slice(s, F.lit(2), n - 1), F.array(last))
        before = F.concat(F.array(last), F.slice(s, F.lit(1), n - 1))
        marked = F.zip_with(F.zip_with(s, after, lambda x, y: F.struct(
            x["i"].alias("i"), x["h"].alias("h"), F.coalesce(x["h"] == y["h"], F.lit(False)).alias("twin"))),
            before, lambda x, y: F.when(x["twin"] | F.coalesce(x["h"] == y["h"], F.lit(False)), x["i"]))
        return let(F.sort_array(F.array_compact(marked)), span)

    def span(places):
        # each place covers three words, less what the next place covers anyway
        steps = F.zip_with(F.slice(places, F.lit(2), F.size(places)), F.slice(places, F.lit(1), F.size(places) - 1),
                           lambda b, a: F.least(b - a, F.lit(3)))
        return F.aggregate(steps, F.lit(3), lambda s, x: s + x)

    return F.when(F.size(ws) < 3, F.lit(0)).otherwise(let(ws, of))


def measure(docs: DataFrame, text: str = "text", name: str = "_q") -> DataFrame:
    """``docs`` with a struct of all features."""
    t = F.coalesce(F.col(text), F.lit(""))
    stop = sorted({*STOP_WORDS, *(w.capitalize() for w in STOP_WORDS)})

    def counts(ws):
        lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(f"[^{SPACE_CLASS}]"))
        return F.struct(
            F.size(ws).cast("long").alias("n_words"),
            F.length(F.array_join(ws, "")).cast("long").alias("word_chars"),
            F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup"))
                 ).alias("lines"),
            repeat_words(ws).cast("long").alias("n_repeat_words"),
            F.size(F.filter(ws, lambda w: w.isin(stop))).alias("n_stop"))

    return docs.withColumn(name, let(words(F.col(text)), counts))


def compiled(rules: list[Rule], name: str = "_q") -> Column:
    """One Boolean expression over the features: true where no rule rejects."""
    q = F.col(name)
    n = F.greatest(q["n_words"], F.lit(1)).cast("double")
    features = {
        "n_words": q["n_words"].cast("double"),
        "repeat_share": q["n_repeat_words"] / n,
        "symbol_ratio": q["n_symbols"] / n,
        "dup_line_share": q["lines"]["dup"] / F.greatest(q["lines"]["n"], F.lit(1)),
        "word_length": q["word_chars"] / n,
        "stop_share": q["n_stop"] / n,
    }
    ok = F.lit(True)
    for r in rules:
        if r.least is not None:
            ok = ok & (features[r.feature] >= r.least)
        if r.most is not None:
            ok = ok & (features[r.feature] <= r.most)
    return ok


def base_failed(name: str = "_q") -> Column:
    q = F.col(name)
    return (q["n_words"] < 50) | (q["n_repeat_words"] * 100 > q["n_words"] * 50)


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """``key``, the features and both verdicts: one row per row."""
    q = F.col("_q")
    m = measure(docs.select(F.col(key), F.col(text)), text)
    return m.select(F.col(key), q["n_words"].alias("n_words"), q["word_chars"].alias("word_chars"),
                    q["n_symbols"].alias("n_symbols"), q["lines"]["dup"].cast("long").alias("n_dup_lines"),
                    q["n_repeat_words"].alias("n_repeat_words"), base_failed().alias("base_failed"),
                    (~base_failed() & compiled(rules)).alias("kept"))


def keep_good(docs: DataFrame, text: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """The rows of ``docs`` that pass, all columns as they were."""
    q = unused(docs) + "q"
    return measure(docs, text, q).filter(~base_failed(q) & compiled(rules, q)).drop(q)
