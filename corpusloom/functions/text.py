"""Text functions as column expressions; only Unicode normalisation leaves the JVM, in Arrow batches."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that normalisation replaces, besides white space and ASCII punctuation (fixed values).
PUNCTUATION = "！？｡。＂＃＄％＆＇（）＊＋，－／：；＜＝＞＠［＼］＾＿｀｛｜｝～｟｠｢｣､、〃》「」『』【】〔〕〖〗〘〙〚〛〜〝〞〟〰〾〿–—‘’‛“”„‟…‧﹏"
_ASCII = "".join(f"\\{chr(c)}" for c in range(33, 127) if not chr(c).isalnum())
#: White space as Python knows it, in Java's syntax.
SPACE = r"\s\x1c-\x1f"
SEPARATORS = f"(?U)[{SPACE}{PUNCTUATION}{_ASCII}]+"
#: Also the gap between two ideographs.
SEPARATORS_SPLIT = SEPARATORS + r"|(?<=[\x{4e00}-\x{9fff}])(?=[\x{4e00}-\x{9fff}])"
#: The same in Python's syntax, where \s has all of that.
PYTHON_SEPARATORS = rf"[\s{PUNCTUATION}{_ASCII}]+"
PYTHON_SEPARATORS_SPLIT = PYTHON_SEPARATORS + "|(?<=[\u4e00-\u9fff])(?=[\u4e00-\u9fff])"
NON_WORD = r"[^\p{L}\p{N}_]"


#: Bytes of text that a Python worker makes strings of at a time, whatever the size of the batches that Spark sends.
SLICE_BYTES = 2**20
#: A text without any such character is NFKC already: ASCII, and the letters of Latin-1, which are composed.
UNSTABLE = r"[^\x00-\x7f\x{c0}-\x{ff}]"


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(begin, rows) of consecutive runs of ``limit`` bytes at most, or of one text that is longer."""
    begin = held = 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if i > begin and held + n > limit:
            yield begin, i - begin
            begin, held = i, 0
        held += n
    if len(texts) > begin:
        yield begin, len(texts) - begin


def nfkc_array(texts: pa.Array) -> pa.Array:
    """NFKC of every text; only a slice at a time is held as Python strings, and slices of nulls stay as they are."""
    form = lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFKC", t)
    parts = (texts.slice(*s) for s in slices(texts))
    done = [p if p.null_count == len(p) else pa.array([form(t) for t in p.to_pylist()], texts.type) for p in parts]
    return pa.concat_arrays(done) if done else texts


@cache
def _nfkc():
    @F.arrow_udf("string")
    def nfkc(texts: pa.Array) -> pa.Array:
        return nfkc_array(texts)

    return nfkc


def normalize(text: Column, split_ideographs: bool = False, unicode_form: bool = True) -> Column:
    """Lower-cased, NFKC, with runs of separators replaced by a space. Only texts that can change are sent to the Arrow pass, nulls in place of others;
    ``unicode_form=False`` leaves it out for corpora known to be stable."""
    lower = F.lower(text)
    formed = F.coalesce(_nfkc()(F.when(lower.rlike(UNSTABLE), lower)), lower) if unicode_form else lower
    return F.regexp_replace(formed, SEPARATORS_SPLIT if split_ideographs else SEPARATORS, " ")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once: a lambda's variable can't be replaced by its expression, as a column can."""
    return F.element_at(F.transform(F.array(value), use), 1)


def tokens(content: Column) -> Column:
    """Split at single non-word characters; empty tokens stay."""
    return F.split(content, NON_WORD, -1)


def shingles(tokens_: Column, n: int, min_length: int) -> Column:
    """Distinct n-grams joined by spaces; one gram of all tokens if there are fewer than n, none below ``min_length``."""
    slide = lambda t: F.transform(F.sequence(F.lit(1), F.greatest(F.size(t) - n + 1, F.lit(1))), lambda i: F.array_join(F.slice(t, i, n), " "))
    return let(tokens_, lambda t: F.when(F.size(t) < min_length, F.array().cast("array<string>")).otherwise(F.array_distinct(slide(t))))


def hash32(text: Column) -> Column:
    """The first four bytes of SHA-1, little-endian, as a long."""
    h = F.sha1(F.lower(text).cast("binary"))
    return F.conv(F.concat(*(F.substring(h, i, 2) for i in (7, 5, 3, 1))), 16, 10).cast("long")


def stripped_length(text: Column) -> Column:
    """Code points of a text without white space at its ends and without any space, line feed or tab."""
    return F.length(F.translate(F.regexp_replace(text, rf"(?U)^[{SPACE}]+|[{SPACE}]+$", ""), " \n\t", ""))


def line_count(text: Column) -> Column:
    return F.size(F.split(text, "\n", -1))


def body_lines(text: Column, selector: Column) -> Column:
    """The lines that a JSON selector {"line_id": [1-based numbers]} names, in its order; '' if anything is amiss."""
    lines = F.split(text, "\n", -1)
    kind = lambda x: F.schema_of_variant(x)
    number = lambda x: F.when(kind(x) == "BIGINT", F.try_variant_get(x, "$", "bigint")).when(kind(x) == "BOOLEAN", F.try_variant_get(x, "$", "boolean").cast("bigint"))
    ids = F.transform(F.try_variant_get(F.try_parse_json(selector), "$.line_id", "array<variant>"), number)
    picked = F.transform(F.filter(ids, lambda i: i.between(1, F.size(lines))), lambda i: F.get(lines, i.cast("int") - 1))
    return F.coalesce(F.array_join(picked, "\n"), F.lit(""))


def human(n: int) -> str:
    for size, unit in ((10**9, "B"), (10**6, "M"), (10**3, "K")):
        if n >= size:
            return f"{n / size:.2f}{unit}"
    return str(n)
