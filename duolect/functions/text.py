"""String columns: identifiers, paths, languages, transcripts and error texts."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

# The error texts of the ledger.
MISSING_CLIP = "Audio file not found: "
EMPTY_TARGET = "[chatterbox-tts] Empty text provided for synthesis"
BAD_PAIR = "Unsupported language pair: "

# Fixed value: characters an identifier may not keep, each replaced by "_".
UNSAFE_ID_CHARS = "/\\:"

# Python's notion of whitespace: all of Unicode's plus U+001C..U+001F.
WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
_WORD_GAP = r"(?U)[\s\x1c-\x1f]++"


# A path that is not relative: rooted, with a drive, or with a scheme.
_ABSOLUTE = "^(/|[A-Za-z]:/|[A-Za-z][A-Za-z0-9+.-]*://)"
# Control, format, unassigned and private characters, and separators but for the space.
_UNPRINTABLE = r"[\p{C}\p{Zl}\p{Zp}\p{Zs}&&[^ ]]"
_PRINTABLE = r"[^\p{C}\p{Zl}\p{Zp}\p{Zs}]|[ ]"
# Words to either side of the diagonal that are searched first.
LEAST_BAND = 8
_ODD = r"[\p{C}\p{Zl}\p{Zp}\p{Zs}&&[^ \n\r\t]]"


def strip(text: Column) -> Column:
    """Trim all Unicode whitespace plus U+001C..U+001F from both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def is_blank(text: Column) -> Column:
    """True for null, empty and whitespace-only text."""
    return text.isNull() | (strip(text) == "")


def text_key(text: Column) -> Column:
    """What a text is looked up by: its SHA-256."""
    return F.sha2(text, 256)


def sanitize_id(raw_id: Column) -> Column:
    return F.translate(raw_id, UNSAFE_ID_CHARS, "_" * len(UNSAFE_ID_CHARS))


def source_lang(direction: Column) -> Column:
    return F.substring(direction, 1, 2)


def target_lang(direction: Column) -> Column:
    return F.substring(direction, 3, 2)


def lang_code(lang: Column, codes: dict[str, str] | None = None) -> Column:
    """A model's own code for a language; upper case where it lists none."""
    upper = F.upper(lang)
    if not codes:
        return upper
    pairs = [F.lit(part) for item in codes.items() for part in item]
    return F.coalesce(F.create_map(*pairs)[lang], upper)


def lang_pair_supported(src: Column, tgt: Column, languages: Iterable[str]) -> Column:
    names = list(languages)
    return F.coalesce(src.isin(names) & tgt.isin(names), F.lit(False))


def output_key(direction: Column, sample_id: Column, root: str = "data/parallel") -> Column:
    return F.concat_ws("/", F.lit(root), direction, sample_id)


def resolve_path(path: Column, root: str) -> Column:
    """Join to the data root; backslashes separate, an absolute path or URI stands alone."""
    slashed = F.translate(path, "\\", "/")
    base = root.replace("\\", "/").rstrip("/")
    return F.when(slashed.rlike(_ABSOLUTE), slashed).otherwise(
        F.concat(F.lit(base + "/"), slashed))


def listed_path(uri: Column) -> Column:
    """A listing's ``file:`` URI as the plain path manifests resolve to."""
    return F.regexp_replace(uri, "^file:/+", "/")


def preview(text: Column, length: int = 80) -> Column:
    return F.left(text, F.lit(length))


def text_line(text: Column) -> Column:
    return F.concat(text, F.lit("\n"))


def _hex_escaped(message: Column) -> Column:
    """Characters that Python's repr writes as hex, escaped; texts are taken apart at these only."""
    def escape(part: Column) -> Column:
        point = F.ascii(part)
        code = lambda mark, width: F.concat(F.lit(mark), F.lpad(F.lower(F.hex(point)), width, "0"))
        shown = F.when(point < 256, code("\\x", 2)).when(point < 65536, code("\\u", 4)).otherwise(code("\\U", 8))
        return F.when(part.rlike(_UNPRINTABLE), shown).otherwise(part)

    return F.array_join(F.transform(F.regexp_extract_all(message, F.lit(f"{_UNPRINTABLE}|(?:{_PRINTABLE})++"), F.lit(0)), escape), "")


def error_repr(kind: Column, message: Column) -> Column:
    """``Kind('message')`` with Python's quoting: double quotes only around a
    message that holds a single quote and no double quote."""
    escaped = F.replace(message, F.lit("\\"), F.lit("\\\\"))
    for char, code in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        escaped = F.replace(escaped, F.lit(char), F.lit(code))
    # The first test is quick and settles most texts; each branch works the text out once.
    odd = message.rlike(r"[^\x20-\x7e\n\r\t]") & message.rlike(_ODD)
    quoted_twice = F.contains(message, F.lit("'")) & ~F.contains(message, F.lit('"'))
    body = F.when(odd, _hex_escaped(escaped)).otherwise(escaped)
    mark = F.when(quoted_twice, F.lit('"')).otherwise(F.lit("'"))
    shown = F.when(quoted_twice, body).otherwise(F.replace(body, F.lit("'"), F.lit("\\'")))
    return F.concat(kind, F.lit("("), mark, shown, mark, F.lit(")"))


def debug_status(error: Column) -> Column:
    return F.when(error.isNotNull(), F.concat(F.lit("error: "), error)).otherwise(F.lit("ok"))


# Fixed value: the wording of the message.
def empty_source_message(sample_id: Column, text_column: str) -> Column:
    return F.concat(F.lit("Empty manifest text for id="), sample_id,
                    F.lit(f", column={text_column!r}"))


def word_edits(reference: str, hypothesis: str) -> int:
    """Word-level edit distance; shared ends are dropped first, which is exact.

    A band around the diagonal is searched, and doubled until the distance found fits in
    it, so time grows with the length times the distance.
    """
    vocabulary: dict[str, int] = {}
    left, right = (np.array([vocabulary.setdefault(w, len(vocabulary)) for w in t.split()], np.int64)
                   for t in (reference, hypothesis))
    shared = min(len(left), len(right))
    differs = np.flatnonzero(left[:shared] != right[:shared])
    head = int(differs[0]) if differs.size else shared
    left, right = left[head:], right[head:]
    shared = min(len(left), len(right))
    differs = np.flatnonzero(left[::-1][:shared] != right[::-1][:shared])
    tail = int(differs[0]) if differs.size else shared
    left, right = left[:len(left) - tail], right[:len(right) - tail]
    if not left.size or not right.size:
        return max(left.size, right.size)
    band = max(abs(left.size - right.size), LEAST_BAND)
    while (found := _banded(left, right, band)) > band:
        band *= 2
    return found


def _banded(left: np.ndarray, right: np.ndarray, band: int) -> int:
    """The edit distance of paths that stay within ``band`` of the diagonal: the true one if
    it is no more than that, since a path of d edits never strays further than d."""
    offsets = np.arange(-band, band + 1)
    far = left.size + right.size + 1
    padded = np.concatenate([np.full(band + 1, -1), right, np.full(max(left.size + band - right.size, 0) + 1, -1)])
    row = np.where(offsets >= 0, offsets, far)
    for i, word in enumerate(left, 1):
        place = offsets + i
        best = row + (padded[i:i + offsets.size] != word)
        best[:-1] = np.minimum(best[:-1], row[1:] + 1)
        best[place == 0] = i
        best[(place < 0) | (place > right.size)] = far
        # an insertion chain costs one per step: a running minimum of best - position
        row = np.minimum.accumulate(best - offsets) + offsets
    return int(row[band + right.size - left.size])


@F.pandas_udf(IntegerType())
def _word_edits(reference: pd.Series, hypothesis: pd.Series) -> pd.Series:
    return pd.Series([word_edits(r, h) for r, h in zip(reference, hypothesis)], dtype="int32")


def compare_transcripts(df: DataFrame, reference: str = "text", hypothesis: str = "src_text") -> DataFrame:
    """Exact-match flag, word edits and word error rate of a transcript against
    the manifest text. Equal transcripts are settled before Python sees them."""
    ref, hyp = (strip(F.coalesce(F.col(c), F.lit(""))) for c in (reference, hypothesis))
    flagged = df.withColumn("exact_match", ref == hyp)
    # empty strings keep the batches aligned and cost no comparison
    edits = _word_edits(F.when(~F.col("exact_match"), ref).otherwise(""),
                        F.when(~F.col("exact_match"), hyp).otherwise(""))
    return flagged.withColumns({
        "ref_words": F.when(ref == "", 0).otherwise(F.regexp_count(ref, F.lit(_WORD_GAP)) + 1),
        "word_edits": edits,
    }).withColumn("word_error_rate", F.when(F.col("ref_words") > 0,
                                            F.col("word_edits") / F.col("ref_words")))
