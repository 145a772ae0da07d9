"""Per-token string functions (orthographic features)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: character classes that must agree with Python's str predicates ---
UPPER = r"\p{IsUppercase}"
LOWER = r"\p{IsLowercase}"
TITLECASE = r"\p{Lt}"
CASED = UPPER + LOWER + TITLECASE
# characters for which str.isdigit() holds: decimal digits, then the digits that are not decimal
DIGIT = (
    r"\p{Nd}"
    r"²³¹፩-፱᧚⁰⁴-⁹₀-₉①-⑨⑴-⑼⒈-⒐⓪⓵-⓽⓿❶-❾➀-➈➊-➒"
    r"\x{10A40}-\x{10A43}\x{10E60}-\x{10E68}\x{11052}-\x{1105A}\x{1F100}-\x{1F10A}"
)
# characters removed by str.strip()
BLANK = r"\s\x1c-\x1f\x85\p{Z}"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"
ASCII_DIGIT = "0123456789"
# --- end of fixed values ---


def strip(text: Column) -> Column:
    """Remove leading and trailing Unicode white space."""
    return F.regexp_replace(text, f"^[{BLANK}]+|[{BLANK}]+$", "")


def beyond_ascii(form: Column) -> Column:
    """Some character is not ASCII, so that it takes more than one byte."""
    return F.octet_length(form) != F.length(form)


def casing(form: Column) -> Column:
    """ALLCAPS, TITLE, LOWER, MIXED or NOCASE.

    The tests exclude each other, so the commonest answers come first. Title case means that
    capitals follow uncased characters only and small letters follow cased ones only.
    """
    has_upper = form.rlike(f"[{UPPER}]")
    has_title = form.rlike(f"[{TITLECASE}]")
    has_lower = form.rlike(f"[{LOWER}]")
    broken_title = form.rlike(f"[{CASED}][{UPPER}{TITLECASE}]|(?:^|[^{CASED}])[{LOWER}]")
    return (
        F.when(form.rlike("^[a-z]+$"), "LOWER")
        .when(form.rlike("^[^A-Za-z\\x80-\\x{10FFFF}]*$"), "NOCASE")
        .when(has_upper & ~has_lower & ~has_title, "ALLCAPS")
        .when((has_upper | has_title) & ~broken_title, "TITLE")
        .when(has_lower & ~has_upper & ~has_title, "LOWER")
        .when(has_upper, "MIXED")
        .otherwise("NOCASE")
    )


def word_shape(form: Column) -> Column:
    """Capitals become X, other letters x, digits d; every other character stays."""
    ascii_shape = F.translate(
        form,
        ASCII_UPPER + ASCII_LOWER + ASCII_DIGIT,
        "X" * len(ASCII_UPPER) + "x" * len(ASCII_LOWER) + "d" * len(ASCII_DIGIT),
    )
    upper = F.regexp_replace(form, rf"[\p{{L}}&&[{UPPER}]]", "X")
    letters = F.regexp_replace(upper, rf"[\p{{L}}&&[^{UPPER}]]", "x")
    # the capitals just written as X and the letters written as x are not digits
    return F.when(beyond_ascii(form), F.regexp_replace(letters, f"[{DIGIT}]", "d")).otherwise(ascii_shape)


def prefix(form: Column, n: int) -> Column:
    return F.when(F.length(form) >= n, F.lower(F.substring(form, 1, n)))


def suffix(form: Column, n: int) -> Column:
    return F.when(F.length(form) >= n, F.lower(F.right(form, F.lit(n))))


def char_ngram(form: Column, n: int, k: int) -> Column:
    """The ``k``-th (0-based) lower-cased character n-gram; a shorter form is its own first n-gram."""
    gram = F.when(F.length(form) >= n + k, F.lower(F.substring(form, k + 1, n)))
    return F.coalesce(gram, F.when(F.length(form) < n, F.lower(form))) if k == 0 else gram


def has_digit(form: Column) -> Column:
    return form.rlike("[0-9]") | (beyond_ascii(form) & form.rlike(f"[{DIGIT}]"))


def has_hyphen(form: Column) -> Column:
    return form.contains("-")


def has_parenthesis(form: Column) -> Column:
    return form.contains("(") | form.contains(")")


def has_bracket(form: Column) -> Column:
    return form.contains("[") | form.contains("]")


def is_long(form: Column) -> Column:
    return F.length(form) > 10


def escape(text: Column) -> Column:
    """Line feeds and tabs as two-character escapes, for one-line text formats."""
    return F.replace(F.replace(text, F.lit("\n"), F.lit("\\n")), F.lit("\t"), F.lit("\\t"))


def lcs_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence, by dynamic programming over two folds."""
    chars_b = F.split(b, "")
    zeros = F.array_repeat(F.lit(0), F.length(b))

    def next_row(row: Column, ch: Column, cs: Column) -> Column:
        start = F.struct(
            F.lit(0).alias("diag"), F.lit(0).alias("left"), F.array().cast("array<int>").alias("row")
        )

        def cell(acc: Column, c: Column) -> Column:
            up = F.get(row, F.size(acc.row))
            here = F.when(c == ch, acc.diag + 1).otherwise(F.greatest(up, acc.left))
            return F.struct(up.alias("diag"), here.alias("left"), F.array_append(acc.row, here).alias("row"))

        return F.aggregate(cs, start, cell).row

    table = F.transform(
        F.array(chars_b),
        lambda cs: F.aggregate(F.split(a, ""), zeros, lambda row, ch: next_row(row, ch, cs)),
    )[0]
    return F.when((F.length(a) == 0) | (F.length(b) == 0), 0).otherwise(F.element_at(table, -1))
