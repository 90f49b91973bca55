"""Personal data in texts, in Spark's own functions only.

Regular expressions propose spans, leftmost and non-overlapping per kind. Checks confirm them:
the range of address parts, Luhn's sum, digit counts, the mod-97 sum of account numbers. Each kind
starts from a score; nearby context words raise it, and a span stays at ``THRESHOLD`` or more.

Kinds ``email ip card phone`` are the base: a span that passes its check always stays. The method
adds ``iban`` (mod-97 confirmed) and ``local`` (a phone number without ``+``, which needs a
context word near it). Context is the ``CONTEXT_CHARS`` code points of the text on either side of a span,
other matches among them included.

Account numbers have the length of their country, so that a word after one is not taken for its tail. Those
of a country or length not in ``ACCOUNT_SIZES`` are read as far as they go, up to the next number of a listed one.

Positions are code points, the end exclusive. They come from splitting the text at the pattern and
adding up the lengths of the pieces and matches (``scan_array``, which does not slow down where a text
has very many). Patterns are possessive and anchored to
the start of a run of characters, so none backtracks over a long run or recurses; ``iban`` goes back over 35 characters at most.

Null text counts as empty: no spans. Each row is judged alone: repeated rows and null ids get their
rows, other columns are left out of ``find`` and kept by ``mask``. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentrisk.llm.common import let, scan_array

BASE = ["email", "ip", "card", "phone"]
KINDS = [*BASE, "iban", "local"]
THRESHOLD = 0.5
MATCH = "struct<s:int,e:int,around:string>"

#: Characters of an account number (IBAN registry, and the countries that use the format outside it).
ACCOUNT_SIZES = {
    15: "NO", 16: "BE", 18: "DK|FI|FK|FO|GL|NL|SD", 19: "MK|SI", 20: "AT|BA|EE|KZ|LT|LU|MN|XK", 21: "CH|HR|LI|LV",
    22: "BG|BH|CR|DE|GB|GE|IE|ME|RS|VA", 23: "AE|GI|IL|IQ|OM|SO|TL", 24: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG",
    25: "AO|CV|GW|LY|MZ|PT|ST", 26: "DZ|IR|IS|TR", 27: "BI|CF|CG|CM|DJ|FR|GA|GQ|GR|IT|KM|MC|MG|MR|SM|TD",
    28: "AL|AZ|BF|BJ|BY|CI|CY|DO|GT|HN|HU|LB|MA|ML|NE|NI|PL|SN|SV|TG", 29: "BR|EG|PS|QA|UA", 30: "JO|KW|MU|YE",
    31: "MT|SC", 32: "LC", 33: "RU"}


def _account() -> str:
    """Pattern of account numbers: in one run, or in groups of four with a space between."""
    def exact(n, countries):
        rest = rf"(?:\x20?+[A-Z0-9]{{4}}){{{(n - 4) // 4}}}" + (rf"\x20?+[A-Z0-9]{{{n % 4}}}" if n % 4 else "")
        return rf"(?:{countries})[0-9]{{2}}{rest}(?![A-Za-z0-9])"

    listed = "(?:" + "|".join(exact(n, c) for n, c in ACCOUNT_SIZES.items()) + ")"
    other = (rf"[A-Z]{{2}}[0-9]{{2}}(?:(?!\x20{listed})\x20?+[A-Z0-9]{{4}}){{2,7}}"
             rf"(?:(?!\x20{listed})\x20?+[A-Z0-9]{{1,3}})?(?![A-Za-z0-9])")
    return rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{listed}|{other})"


# A run of the class is entered at its start, or where the last match ended (\G); from any later place
# of the same run the outcome is the same, so these find what the plain patterns of the contract find.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": _account(),
    "local": r"(?<![A-Za-z0-9+.,-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![A-Za-z0-9-]|\.[0-9])",
}
#: A text without this cannot hold the kind.
NEEDS = {"email": r"@", "ip": r"\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]",
         "iban": r"[A-Z]{2}[0-9]{2}", "local": r"[0-9]{3}[\x20.-][0-9]{4}"}
#: Score of a span that passed its check, and what a context word adds.
SCORE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "local": 0.3}
BONUS = 0.3
CONTEXT_CHARS = 40
CONTEXT = {
    "email": "mail|contact|write|kontakt|correo|courriel",
    "ip": "ip|address|server|host|adresse|servidor",
    "card": "card|visa|credit|karte|carte|tarjeta",
    "phone": "phone|tel|call|fax|mobile|telefon|appel|llama",
    "iban": "iban|account|bank|konto|compte|cuenta",
    "local": "phone|tel|call|fax|mobile|telefon|appel|llama",
}


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True where the digit string has Luhn's checksum."""
    places = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(places, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(account: Column) -> Column:
    """True where an account number (spaces allowed) has remainder 1: the mod-97 check of IBANs."""
    a = F.regexp_replace(account, " ", "")
    turned = F.concat(F.substring(a, 5, 60), F.substring(a, 1, 4))
    # letters count as two digits, A = 10
    return F.aggregate(F.split(turned, ""), F.lit(0), lambda r, c: F.when(
        c.between("0", "9"), (r * 10 + F.ascii(c) - 48) % 97).otherwise((r * 100 + F.ascii(c) - 55) % 97)) == 1


def confirmed(kind: str, match: Column) -> Column:
    n = F.length(_digits(match))
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: F.length(F.ltrim(p, F.lit("0"))).between(0, 3)
                        & (F.coalesce(F.substring(F.ltrim(p, F.lit("0")), 1, 3).try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        # the sum is taken of candidates of the right length only
        return F.when(n.between(13, 19), luhn(_digits(match))).otherwise(False)
    if kind == "phone":
        return n.between(9, 15)
    if kind == "iban":
        return mod97(match)
    return F.lit(True)


def _around(matches: Column, pieces: Column, i: Column) -> Column:
    """The text before and after match ``i``, a line feed between; ``pieces`` lie between the matches, which end with ''.

    A match has two characters or more, so ``CONTEXT_CHARS / 2`` matches and pieces on a side are enough.
    """
    n = CONTEXT_CHARS // 2
    first = F.greatest(F.lit(0), i - n)

    def ends(x):
        return F.when(F.length(x) > 2 * CONTEXT_CHARS, F.concat(
            F.substring(x, 1, CONTEXT_CHARS), F.substring(x, -CONTEXT_CHARS, CONTEXT_CHARS))).otherwise(x)

    def text(pairs):
        return F.array_join(F.transform(pairs, lambda x: F.concat(ends(x["a"]), ends(x["b"]))), "")

    def pair(a, b):
        return F.struct(a.alias("a"), b.alias("b"))

    before = F.concat(text(F.zip_with(F.slice(pieces, first + 1, i - first), F.slice(matches, first + 1, i - first), pair)),
                      ends(F.get(pieces, i)))
    after = text(F.zip_with(F.slice(pieces, i + 2, F.lit(n)), F.slice(matches, i + 2, F.lit(n)), pair))
    return F.concat(F.substring(before, -CONTEXT_CHARS, CONTEXT_CHARS), F.lit("\n"), F.substring(after, 1, CONTEXT_CHARS))


def proposals(kind: str, text: Column) -> Column:
    """Array of (s, e, around): every match of the kind's pattern; ``around`` is null where the check fails."""
    pattern = PATTERNS[kind]
    pieces = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = let(F.struct(matches.alias("m"), F.concat(matches, F.array(F.lit(""))).alias("ended"), pieces.alias("p")),
                lambda t: F.transform(t["m"], lambda m, i: F.struct(
                    F.length(F.get(t["p"], i)).alias("gap"), F.length(m).alias("size"),
                    F.when(confirmed(kind, m), _around(t["ended"], t["p"], i)).alias("around"))))

    def step(at, x):
        s = at + x["gap"]
        e = s + x["size"]
        return e, F.struct(s.alias("s"), e.alias("e"), x["around"].alias("around"))

    found = let(pairs, lambda p: scan_array(p, step, MATCH))
    return F.when(text.rlike(NEEDS[kind]), found).otherwise(F.array().cast(f"array<{MATCH}>"))


def spans_of(kind: str, text: Column) -> Column:
    """Array of (s, e, score) of the kind's confirmed spans, from the left."""
    near = lambda x: F.lower(x["around"]).rlike(rf"(?<![a-z])(?:{CONTEXT[kind]})")
    kept = F.filter(proposals(kind, text), lambda x: x["around"].isNotNull())
    scored = F.transform(kept, lambda x: F.struct(
        x["s"].alias("s"), x["e"].alias("e"),
        F.least(F.lit(1.0), F.lit(SCORE[kind]) + F.when(near(x), BONUS).otherwise(0.0)).alias("score")))
    return F.filter(scored, lambda x: x["score"] >= THRESHOLD)


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and an array column (s, e, score) per kind."""
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(key), *[spans_of(k, t).alias(k) for k in KINDS])


def digest(kinds: list[str]) -> Column:
    """``kind:start:end`` of all spans of the kinds, comma-joined."""
    def shown(kind):
        return F.transform(F.col(kind), lambda x: F.concat(
            F.lit(f"{kind}:"), x["s"].cast("string"), F.lit(":"), x["e"].cast("string")))

    return F.array_join(F.concat(*[shown(k) for k in kinds]), ",")


def mask(docs: DataFrame, text: str = "text") -> DataFrame:
    """Replace every span by ``<KIND>`` in the text column; overlapping spans give one mark, of the first.

    All other columns stay. Null text stays null.
    """
    t = F.col(text)

    def tagged(i, kind):
        return F.transform(spans_of(kind, F.coalesce(t, F.lit(""))), lambda x: F.struct(
            x["s"].alias("s"), F.lit(i).alias("k"), x["e"].alias("e")))

    found = F.concat(*[tagged(i, k) for i, k in enumerate(KINDS)])
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])

    def step(at, x):
        piece = F.concat(F.substring(t, at + 1, x["s"] - at), F.get(names, x["k"]))
        return F.greatest(at, x["e"]), F.when(x["s"] >= at, piece)

    masked = let(F.sort_array(found), lambda spans: F.when(F.size(spans) == 0, t).otherwise(F.concat(
        F.array_join(scan_array(spans, step, "string"), ""),
        F.substring(t, F.array_max(F.transform(spans, lambda x: x["e"])) + 1, F.length(t)))))
    return docs.withColumn(text, masked)
