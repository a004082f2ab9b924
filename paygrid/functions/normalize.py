"""Scalar column functions, all built-in expressions (codegen, no UDF)."""

from __future__ import annotations

import unicodedata
from collections.abc import Collection
from decimal import Decimal
from functools import lru_cache

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(15,2)"


def zero() -> Column:
    """0.00 as money."""
    return F.lit(Decimal("0.00")).cast(MONEY)


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --- I1..I4: normalisers -------------------------------------------------------

# Characters removed by the source's strip(): every code point whose str.isspace() is
# true (derived from the rule, so it matches the source exactly).
WHITESPACE = "".join(chr(i) for i in range(0x110000) if chr(i).isspace())
# The same set as a regex character class (Java syntax), for whitespace runs.
WS_CLASS = "[" + "".join(f"\\u{ord(ch):04x}" for ch in WHITESPACE) + "]"


@lru_cache(maxsize=1)
def _spaces(context: SparkContext) -> list[Column]:
    """The whitespace characters as literals, made once a session: every text column looks for them."""
    return [F.lit(ch) for ch in WHITESPACE]


def strip_ws(col: Column | str) -> Column:
    """Strip leading/trailing whitespace (no regex: a plain trim over a character set).

    A trim over a character set walks the whole text; only texts that begin or end with
    whitespace, which two look-ups tell, go through it.
    """
    text = _c(col).cast("string")
    spaces = _spaces(SparkContext._active_spark_context)
    edge = F.substring(text, 1, 1).isin(spaces) | F.substring(text, -1, 1).isin(spaces)
    return F.when(edge, F.trim(text, F.lit(WHITESPACE))).otherwise(text)


def norm_string(col: Column | str) -> Column:
    """NULL -> NULL; Unicode strip; empty -> NULL."""
    return F.nullif(strip_ws(col), F.lit(""))


def norm_int(col: Column | str, dtype: str = "bigint") -> Column:
    """NULL, NaN and '' -> NULL; else the integer value (other text that is no number raises).

    ``dtype`` is the column's type: only text can be empty, only floating point can be NaN.
    """
    c = _c(col)
    if dtype == "string":
        c = F.nullif(c, F.lit(""))
    elif dtype in ("double", "float"):
        c = F.nanvl(c, F.lit(None).cast(dtype))
    return c.cast("bigint")


WIDE = "decimal(38,2)"      # money before it is known to fit


def norm_decimal_wide(col: Column | str, source: str = "string") -> Column:
    """I3 without a target type: quantised to 0.01 half-even in one step; unparsable -> NULL (no error).

    ``source`` is the column's type: a decimal is rounded as it is, anything else from its text. Every number of up to
    36 integer digits, all that the wide type holds, keeps its value; a longer one is an error.

    Digits after the 19th decimal only matter as "more than a tie": they are kept as one
    final 1, so the conversion to a fixed scale cannot round a value onto a tie first.
    """
    if source.startswith("decimal"):
        return F.bround(_c(col), 2).cast(WIDE)
    raw = _c(col).cast("string")
    text = F.regexp_replace(raw, r"(\.[0-9]{19})0*[1-9][0-9]*", "$1" + "1")
    # Beyond 18 integer digits there is room for ten decimals; what follows the ninth is again kept as a final 1.
    long_text = F.regexp_replace(raw, r"(\.[0-9]{9})0*[1-9][0-9]*", "$1" + "1")
    number = F.coalesce(F.bround(text.try_cast("decimal(38,20)"), 2).cast(WIDE), F.bround(long_text.try_cast("decimal(38,10)"), 2).cast(WIDE))
    longest = r"^\s*[+-]?0*[0-9]{29,36}(\.[0-9]*)?\s*$"
    return F.when(number.isNotNull(), number).when(raw.rlike(longest), _longest_number(raw)).when(
        raw.rlike(r"^\s*[+-]?[0-9]{29,}(\.[0-9]*)?\s*$"), F.raise_error(F.concat(F.lit("number too long: "), raw)))


def _longest_number(raw: Column) -> Column:
    """A number text of 29 to 36 integer digits, half-even: two decimals fill the type, so what follows them is read as text."""
    cut = F.regexp_extract(raw, r"^\s*([+-]?[0-9]+(\.[0-9]{0,2})?)", 1).cast(WIDE)
    rest = F.regexp_extract(raw, r"\.[0-9]{2}([0-9]*)", 1)
    odd = F.regexp_extract(raw, r"\.[0-9]([0-9])", 1).rlike("[13579]")
    up = rest.rlike("^([6-9]|50*[1-9])") | (rest.rlike("^50*$") & odd)
    cent = F.when(raw.rlike(r"^\s*-"), F.lit(Decimal("-0.01"))).otherwise(F.lit(Decimal("0.01")))
    return F.when(up, (cut + cent).cast(WIDE)).otherwise(cut)


def _integer_digits(dtype: str) -> int:
    p, s = dtype[dtype.index("(") + 1:-1].split(",")
    return int(p) - int(s)


def fits(wide: Column, dtype: str = MONEY) -> Column:
    """Whether a number has room in ``dtype`` (NULL where there is no number)."""
    return F.abs(wide) < F.lit(Decimal(10) ** _integer_digits(dtype)).cast("decimal(38,0)")


def norm_decimal(col: Column | str, dtype: str = MONEY, source: str = "string") -> Column:
    """I3 as ``dtype``: a number without room in it is an error, as in the target database, and never NULL.

    ``integrity.check_source_domain`` finds such values beforehand.
    """
    if source.startswith("decimal") and int(source[:-1].split(",")[1]) <= 2 and _integer_digits(source) <= _integer_digits(dtype):
        return _c(col).cast(dtype)
    if source.startswith("decimal") and _integer_digits(source) < _integer_digits(dtype) + (int(source[:-1].split(",")[1]) <= 2):
        return F.bround(_c(col), 2).cast(dtype)
    wide = norm_decimal_wide(col, source)
    error = F.raise_error(F.concat(F.lit(f"no room in {dtype}: "), wide.cast("string")))
    return F.when(wide.isNull() | fits(wide, dtype), wide.cast("decimal(38,2)").try_cast(dtype)).otherwise(error)


def norm_date(col: Column | str, dtype: str = "date") -> Column:
    """I4: date part of a date, timestamp or ISO text; '' -> NULL, other bad text raises."""
    c = _c(col)
    return (F.nullif(c, F.lit("")) if dtype == "string" else c).cast("date")


# --- I7, I8: item total, stable hash --------------------------------------------

def item_total(vantagem: Column | str, auxiliar: Column | str, desconto: Column | str) -> Column:
    """Vantagem + auxiliar - desconto with NULL as 0.00."""
    z = lambda c: F.coalesce(_c(c), zero())
    return (z(vantagem) + z(auxiliar) - z(desconto)).cast(MONEY)


def stable_hash(*parts: Column | str, texts: Collection[str] | None = None) -> Column:
    """I8: SHA-256 hex of the parts as text, each stripped, NULL as '', joined by '||'.

    ``texts`` names the parts that are text, where the caller knows: the others are numbers and dates, which have nothing to strip.
    """
    shown = [strip_ws(p) if texts is None or (isinstance(p, str) and p in texts) else _c(p).cast("string") for p in parts]
    return F.sha2(F.concat_ws("||", *[F.coalesce(s, F.lit("")) for s in shown]), 256)


# --- I9..I11: payroll-run descriptions ------------------------------------------

# Month tokens of run descriptions and their two-digit numbers (fixed values).
MONTH_ALIASES = {
    "JAN": "01", "JANEIRO": "01",
    "FEB": "02", "FEV": "02", "FEVEREIRO": "02",
    "MAR": "03", "MARCO": "03", "MARÇO": "03",
    "APR": "04", "ABR": "04", "ABRIL": "04",
    "MAY": "05", "MAI": "05", "MAIO": "05",
    "JUN": "06", "JUNHO": "06",
    "JUL": "07", "JULHO": "07",
    "AUG": "08", "AGO": "08", "AGOSTO": "08",
    "SEP": "09", "SET": "09", "SETEMBRO": "09",
    "OCT": "10", "OUT": "10", "OUTUBRO": "10",
    "NOV": "11", "NOVEMBRO": "11",
    "DEC": "12", "DEZ": "12", "DEZEMBRO": "12",
}


def norm_folha_desc(col: Column | str) -> Column:
    """Canonical run description.

    Strip, collapse whitespace runs, upper-case; a month token made of letters
    (A-Z, Ç) directly before ``/yyyy`` becomes its two-digit number when it is a
    known alias; a lone digit before ``/yyyy`` is zero-padded. Tokens are whole
    letter runs, so ``FOLHAJAN/2026`` stays as it is.
    """
    out = F.upper(F.regexp_replace(norm_string(col), WS_CLASS + "+", " "))
    # A lower-case letter, which no upper-cased text has, marks every letter run before /yyyy: the aliases are then plain
    # replacements, where a pattern per month would search the text twelve times.
    out = F.regexp_replace(out, r"(?<![A-ZÇ])(?=[A-ZÇ]++/[0-9]{4})", "a")
    for alias, number in MONTH_ALIASES.items():
        out = F.replace(out, F.lit(f"a{alias}/"), F.lit(f"{number}/"))
    return F.regexp_replace(F.replace(out, F.lit("a"), F.lit("")), r"(?<![0-9])([0-9])/([0-9]{4})", r"0$1/$2")


def _fold_tables() -> tuple[str, str, dict[str, str]]:
    """What "NFKD, then drop non-ASCII" makes of every non-ASCII character, built by rule.

    Returns the characters that become one ASCII character with those characters (for
    ``translate``), and the characters that become several (ligatures, fractions, numerals).
    """
    one, to, many = [], [], {}
    for code in range(0x80, 0x110000):
        ch = chr(code)
        folded = unicodedata.normalize("NFKD", ch)
        if folded == ch:
            continue
        ascii_text = folded.encode("ascii", "ignore").decode("ascii")
        if len(ascii_text) == 1:
            one.append(ch)
            to.append(ascii_text)
        elif ascii_text:
            many[ch] = ascii_text
    return "".join(one), "".join(to), many


_FOLD_FROM, _FOLD_TO, _FOLD_MANY = _fold_tables()
_MANY_CLASS = "[" + "".join(f"\\x{{{ord(ch):x}}}" for ch in _FOLD_MANY) + "]"


def norm_token(col: Column | str) -> Column:
    """Text token: strip (NULL -> ''), NFKD-fold to ASCII, collapse spaces, upper.

    Same order as the source: fold, drop what has no ASCII form, then upper-case (so e.g. the
    German sharp s is dropped, not expanded). Characters that unfold to several are rare; only
    texts that hold one go character by character, and only texts that are not ASCII are searched for one.
    """
    base = F.translate(F.coalesce(norm_string(col), F.lit("")), _FOLD_FROM, _FOLD_TO)
    table = F.map_from_arrays(F.array(*[F.lit(k) for k in _FOLD_MANY]), F.array(*[F.lit(v) for v in _FOLD_MANY.values()]))
    unfolded = F.array_join(F.transform(F.split(base, ""), lambda ch: F.coalesce(F.try_element_at(table, ch), ch)), "")
    folded = F.when(F.octet_length(base) == F.length(base), base).when(base.rlike(_MANY_CLASS), unfolded).otherwise(base)
    ascii_only = F.regexp_replace(folded, r"[^\x00-\x7F]", "")
    # Every run of whitespace is one space here.
    return F.upper(F.trim(F.regexp_replace(ascii_only, WS_CLASS + "+", " ")))


def folha_tipo(col: Column | str) -> Column:
    """DECIMO / NORMAL / AVULSO / ESTORNO / OUTROS, first match wins."""
    return token_tipo(norm_token(col))


def token_tipo(token: Column | str) -> Column:
    """I11 from the token (``norm_token``). It is read by every rule: pass a column that holds it."""
    t = _c(token)
    return (
        F.when(t.contains("DECIMO") | t.contains("13"), F.lit("DECIMO"))
        .when(t.contains("NORMAL"), F.lit("NORMAL"))
        .when(t.contains("AVULSA"), F.lit("AVULSO"))
        .when(t.contains("ESTORNO"), F.lit("ESTORNO"))
        .otherwise(F.lit("OUTROS"))
    )


# --- I12, I13: item classification for documents --------------------------------

def decimal_or_zero(col: Column | str) -> Column:
    """NULL / NaN / bad text -> 0.00."""
    c = _c(col)
    return F.coalesce(c.cast("string").try_cast("decimal(38,10)"), F.lit(Decimal("0")))


def item_class(vantagem: Column | str, auxiliar: Column | str, desconto: Column | str) -> tuple[Column, Column]:
    """(tipo, valor): DESCONTO if desconto > 0, else VANTAGEM if vantagem + auxiliar > 0."""
    d = decimal_or_zero(desconto)
    v = decimal_or_zero(vantagem) + decimal_or_zero(auxiliar)
    tipo = F.when(d > 0, F.lit("DESCONTO")).when(v > 0, F.lit("VANTAGEM"))
    valor = F.when(d > 0, d).when(v > 0, v).otherwise(F.lit(Decimal("0"))).cast(MONEY)
    return tipo, valor


# --- I17..I21 -------------------------------------------------------------------

def percent(value: Column | str, total: Column | str) -> Column:
    """0 when total = 0, else 100 * value / total rounded half-even to 2 places."""
    v = _c(value).cast("decimal(38,10)")
    t = _c(total).cast("decimal(38,10)")
    return F.when(t == 0, F.lit(Decimal("0.00"))).otherwise(F.bround(v * 100 / t, 2)).cast("decimal(7,2)")


def iso_date_or_empty(col: Column | str) -> Column:
    """I18."""
    return F.coalesce(F.date_format(_c(col), "yyyy-MM-dd"), F.lit(""))
