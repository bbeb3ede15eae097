"""Fill-in-middle: a document's code points are cut at two ranks and its three parts put into another order.

The units come from the tokenizers library's Split pre-tokenizer, whose pattern matches one code point and isolates it; the
length of its array of offsets is n, and the offsets at the two ranks are the cuts. So that a text of any length needs bounded
memory and only few units are made, Split runs twice: a pattern of up to RUN code points gives an array of runs, and the pattern
of one code point then gives the units of the runs that hold an end or a cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, pre_tokenizers

from evidara.session import bounded_batches

#: Code points of a run.
RUN = 512
#: Code points that are split at once, a multiple of RUN.
BLOCK = 1 << 16
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

_made: dict[int, pre_tokenizers.PreTokenizer] = {}


def splitter(most: int) -> pre_tokenizers.PreTokenizer:
    """Isolates matches of up to `most` code points, line ends included."""
    if most not in _made:
        _made[most] = pre_tokenizers.Split(Regex("(?m)." if most == 1 else f"(?m).{{1,{most}}}"), "isolated")
    return _made[most]


class Units:
    """A text's units: how many there are, and the offset at which a given number of them ends."""

    def __init__(self, text: str, run: int = RUN, block: int = BLOCK):
        self.text, self.run = text, run
        self.runs = [(b + first, b + last) for b in range(0, len(text), block) for _, (first, last) in splitter(run).pre_tokenize_str(text[b : b + block])]
        self.n = (len(self.runs) - 1) * run + len(self.units(len(self.runs) - 1)) if self.runs else 0

    def units(self, k: int) -> list[int]:
        """The ends of the units of run k."""
        first, last = self.runs[k]
        return [first + end for _, (_, end) in splitter(1).pre_tokenize_str(self.text[first:last])] if self.run > 1 else [last]

    def end_of(self, count: int) -> int:
        """The offset after the first `count` units."""
        k, rest = divmod(count, self.run)
        return self.units(k)[rest - 1] if rest else self.runs[k - 1][1] if k else 0


def transform(text: str, key: str, seed: int = 1, run: int = RUN, block: int = BLOCK) -> tuple[int, str, int | None, int | None, str]:
    """(n, form, prefix_chars, middle_chars, output) of a text by four numbers from the sha256 of `seed`:key."""
    digest = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    units = Units(text, run, block)
    if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or h3 % 100 >= 90:
        return units.n, "plain", None, None, text
    cuts = sorted((h1 % (units.n + 1), h2 % (units.n + 1)))
    a, b = map(units.end_of, cuts)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return units.n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return units.n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def restore(output: str, form: str) -> str:
    """The text that `transform` made the output from."""
    if form == "plain":
        return output
    head, _, middle = output.partition(MIDDLE)
    if form == "spm":
        suffix, _, prefix = head.removeprefix(SUFFIX).partition(PREFIX)
    else:
        prefix, _, suffix = head.removeprefix(PREFIX).partition(SUFFIX)
    return prefix + middle + suffix


KIND = "n long, form string, prefix_chars long, middle_chars long"


def fill_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, digests: bool = False, run: int = RUN) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) per row; with `digests`, output_sha256 and restored_sha256 instead of output.

    Forms and cuts depend on the id alone, so rows that repeat an id are cut at ranks from the same numbers; a null id counts as ''.
    A null text is empty, and an empty text plain; texts may have any length; other columns play no part; an empty table gives an
    empty result. Texts that hold a marker are plain, so that every output can be turned back.
    """
    bounded_batches(docs.sparkSession)

    def work(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        hexed = lambda x: hashlib.sha256(x.encode()).hexdigest()
        for keys, texts in columns:
            rows = []
            for key, text in zip(keys.to_pylist(), texts.to_pylist(), strict=True):
                n, form, prefix, middle, output = transform(text or "", key or "", seed, run)
                rows.append((n, form, prefix, middle, *((hexed(output), hexed(restore(output, form))) if digests else (output,))))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), *[pa.string()] * (1 + digests)]
            yield pa.StructArray.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names)

    names = ["n", "form", "prefix_chars", "middle_chars", *(["output_sha256", "restored_sha256"] if digests else ["output"])]
    made = F.arrow_udf(work, f"{KIND}, " + ", ".join(f"{x} string" for x in names[4:]))
    return docs.select(F.col(id_col), made(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(text_col)).alias("__s")).select(id_col, *(f"__s.{x}" for x in names))
