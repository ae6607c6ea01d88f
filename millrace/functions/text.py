"""Text columns: cleaning, name syntax, search terms and labels, all in built-in functions."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rules of the data model that results depend on.
LEGAL_SUFFIXES = ("LLC", "INC", "INCORPORATED", "CORP", "CORPORATION", "LTD", "LIMITED")
STOP_WORDS = ("AT", "IN", "NY", "NYC", "ON")
FINDING_LABELS = (
    ("non-food contact surface", "Equipment or surfaces hard to clean"),
    ("harborage", "Conditions that attract pests"),
    ("anti-siphonage", "Drainage or backflow problems"),
    ("back-flow", "Drainage or backflow problems"),
    ("not protected from potential source of contamination", "Food or equipment exposed to contamination"),
    ("cold tcs", "Cold food held too warm"),
    ("hot tcs", "Hot food held too cool"),
    ("food contact surface", "Food-contact surfaces not properly cleaned"),
    ("hand washing", "Handwashing facilities or practices"),
    ("handwash", "Handwashing facilities or practices"),
    ("wiping cloth", "Wiping cloth storage or cleaning"),
    ("rodent", "Rodent activity or prevention"),
    ("vermin", "Pest activity or prevention"),
)
ISSUE_LABELS = (
    (("cold tcs", "above 41"), "Cold food not kept cold enough"),
    (("hot tcs", "above 140"), "Hot food not kept hot enough"),
    (("food contact surface",), "Food-contact surfaces not properly cleaned"),
    (("not protected from potential source of contamination",), "Food or equipment contamination risk"),
    (("hand washing", "handwash"), "Handwashing rules were not followed"),
    (("pest", "rodent"), "Pest or rodent activity"),
    (("unapproved source",), "Food from an unapproved source"),
)


def cleaned(col: Column) -> Column:
    """White space squeezed and trimmed; nothing left is null."""
    return F.nullif(F.trim(F.regexp_replace(col, r"\s+", " ")), F.lit(""))


def _fold_tables() -> tuple[str, str, list[tuple[str, str]]]:
    one, to, many = [], [], []
    for point in [*range(0xA0, 0x2000), *range(0x2000, 0x2200), *range(0xFB00, 0xFB07), *range(0xFF01, 0xFF5F)]:
        plain = unicodedata.normalize("NFKD", chr(point)).encode("ascii", "ignore").decode()
        if len(plain) == 1:
            one.append(chr(point))
            to.append(plain)
        elif len(plain) > 1:
            many.append((chr(point), plain))
    return "".join(one), "".join(to), many


#: Anything beyond ASCII; the test of a text that mostly has none of it.
BEYOND_ASCII = r"[^\x00-\x7F]"


#: Texts with more different characters beyond ASCII are translated as a whole.
FEW_LETTERS = 32


def ascii_folded(col: Column, without: str | None = None) -> Column:
    """Compatibility decomposition to ASCII: accents go, ligatures and full-width forms become their letters, other characters
    vanish, and so do those that match `without`.

    Texts in ASCII stay as they are after one search. A text with a few letters beyond it has each of these folded and then
    replaced. In others characters with one ASCII letter are translated at once, and the few that become several are looked up
    one by one, only in texts that have any."""
    one, to, many = _fold_tables()
    several = "".join(c for c, _ in many)

    def rest(singles: Column) -> Column:
        wide = singles
        for c, plain in many:
            wide = F.replace(wide, F.lit(c), F.lit(plain))
        folded = F.regexp_replace(F.when(singles.rlike(f"(?={BEYOND_ASCII})[{several}]"), wide).otherwise(singles), BEYOND_ASCII, "")
        return F.when(singles.rlike(BEYOND_ASCII), folded).otherwise(singles)

    whole = lambda text: once(F.translate(F.regexp_replace(text, without, "") if without else text, one, to), rest)
    by_letter = lambda text, letters: F.aggregate(letters, text, lambda t, c: F.replace(t, c, whole(c)))
    letters = lambda text: F.array_distinct(F.regexp_extract_all(text, F.lit(f"({BEYOND_ASCII})"), F.lit(1)))
    folded = lambda text: once(letters(text), lambda found: F.when(F.size(found) <= FEW_LETTERS, by_letter(text, found)).otherwise(whole(text)))
    return once(col, lambda text: F.when(text.rlike(BEYOND_ASCII), folded(text)).otherwise(text))


def once(col: Column, f: Callable[[Column], Column]) -> Column:
    """f of a column that is made once, however often f names it."""
    return F.element_at(F.transform(F.array(col), f), 1)


def name_syntax(col: Column, fold: bool = True) -> Column:
    """A name in upper-case letters, digits and single spaces: apostrophes go, & is AND, store numbers behind # and legal suffixes at the end go."""
    text = F.upper(ascii_folded(col) if fold else col)
    text = F.regexp_replace(text, "['’`]", "")
    text = F.replace(text, F.lit("&"), F.lit(" AND "))
    text = F.regexp_replace(text, r"#\s*[A-Z0-9]+(?:[-/][A-Z0-9]+)*\b", " ")
    text = F.regexp_replace(text, rf"(?:\s*,?\s*\b(?:{'|'.join(LEGAL_SUFFIXES)})\b\.?)+\s*$", " ")
    return F.trim(F.regexp_replace(text, "[^A-Z0-9]+", " "))


def search_terms(col: Column) -> Column:
    """Upper-case words of a search, longer than a letter and no stop words. Letters beyond a-z separate words."""
    upper = F.translate(col, "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    words = F.regexp_extract_all(upper, F.lit("([A-Z0-9]+)"), F.lit(1))
    return F.filter(words, lambda w: (F.length(w) > 1) & ~w.isin(*STOP_WORDS))


def has_terms(text: Sequence[Column], terms: Sequence[str]) -> Column:
    """Whether the upper-case concatenation of columns holds every term."""
    all_of = F.upper(F.concat_ws(" ", *[F.coalesce(t, F.lit("")) for t in text]))
    found = F.lit(True)
    for t in terms:
        found = found & F.contains(all_of, F.lit(t))
    return found


def finding_label(col: Column, most: int = 80) -> Column:
    """A short label of a finding: by the first rule that matches, else its first clause, cut at a word."""
    low = F.lower(col)
    clause = F.trim(F.element_at(F.split(F.element_at(F.split(col, ";"), 1), r"\."), 1))
    cut = F.substring(clause, 1, most - 3)
    short = F.when(F.length(clause) <= most, clause).otherwise(F.concat(F.regexp_replace(cut, r" [^ ]*$", ""), F.lit("…")))
    label = F.when(F.coalesce(col, F.lit("")) == "", F.lit("Violation details unavailable"))
    for phrase, says in FINDING_LABELS:
        label = label.when(F.contains(low, F.lit(phrase)), F.lit(says))
    return label.otherwise(short)


def issue_label(col: Column) -> Column:
    low = F.lower(col)
    label = F.when(F.coalesce(col, F.lit("")) == "", F.lit("No critical issue available"))
    for phrases, says in ISSUE_LABELS:
        hit = F.contains(low, F.lit(phrases[0]))
        for p in phrases[1:]:
            hit = hit | F.contains(low, F.lit(p))
        label = label.when(hit, F.lit(says))
    return label.otherwise(F.lit("Serious food-safety issue recorded"))


def rejections(*rules: tuple[Column, str]) -> Column:
    """The names of the rules that hold, in order."""
    return F.array_compact(F.array(*[F.when(rule, F.lit(name)) for rule, name in rules]))


def row_hash(*columns: str) -> Column:
    """SHA-256 of the columns as JSON, nulls included."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def key_of(*parts: Column) -> Column:
    """A key in lower-case hex of parts joined by ||."""
    return F.sha2(F.concat_ws("||", *[p.cast("string") for p in parts]), 256)
