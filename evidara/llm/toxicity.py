"""Toxicity by a weighted lexicon that an Aho-Corasick automaton matches in folded text.

Folding: compatibility forms, case, accents and zero-width signs go; letters that look like Latin ones become these; digits and signs
that stand for letters become letters inside words. What is left are words of letters with one space between, so that entries of
the lexicon begin (and may end) with a space. Of the entries that begin a word the longest counts; one that lies in an exception
phrase doesn't.

Entries and weights are learned from labelled rows by grouped counts: words and beginnings of words whose documents are toxic far more
often than others, where copies of a text count as one. Exception phrases are words and pairs of words around an entry which documents that aren't toxic hold about as often
or more. A document's evidence is the sum of its weights over a power of its length; power and calibration are fitted on labelled
rows that the lexicon wasn't learned from, by counts in bins.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from zlib import crc32

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidara.llm import textkit as T
from evidara.session import bounded_batches, cut, drop

#: Letters of other scripts that look like Latin letters, and these.
LOOKALIKES = str.maketrans(
    "абвгеёзикмнопрстухьѕіїјԁԛԝһ" + "αβγεηικνορτυχω" + "ıłøđßæœ",
    "abbreeenkmhonpctyxbsiijdqwh" + "abyeniknoptuxw" + "ilodsao",
)
#: Digits and signs that stand for letters inside words.
DIGITS = str.maketrans("013456789@$!|+", "oieasgtbgasilt")
_SWAPPED = re.compile(r"[0-9]|[@$!|+](?=[@$!|+]*[^\W_])")
_WORD = re.compile(r"[^\W\d_]+")
#: Letters of the shortest beginning of a word that can be an entry, and of the longest.
SHORTEST, LONGEST = 4, 8
#: Terms whose counts a task holds before it sends them on.
HELD = 200_000
#: Code points of a long text that are folded at once.
WINDOW = 1 << 20
#: Bins of evidence, and the powers of the length that are tried.
BINS, POWERS = 64, (0.0, 0.5, 1.0)
#: Log ratio up to which words around an entry tell of no toxicity.
HARMLESS = 0.5
#: A document is never taken as shorter than so many words.
LEAST_WORDS = 20


#: Marks that go: what NFKD splits off letters, and signs without width.
MARKS = dict.fromkeys([*range(0x300, 0x370), *range(0x1AB0, 0x1B00), *range(0x20D0, 0x2100), 0xAD, *range(0x200B, 0x2010), 0x2060, 0xFEFF])


def folded_word(word: str) -> str:
    """A word between spaces after folding: words of letters with one space between, or ''."""
    word = word.lower()
    if not word.isascii():
        word = unicodedata.normalize("NFKD", word).lower().translate(MARKS).translate(LOOKALIKES)
    if not word.isalpha():
        if any(c.isalpha() for c in word):
            word = _SWAPPED.sub(lambda m: m[0].translate(DIGITS), word)
        word = " ".join(_WORD.findall(word))
    return word


class Folds(dict):
    """Folded words by word; words of up to 40 code points are kept, and all go when there are too many."""

    def __missing__(self, word: str) -> str:
        out = folded_word(word)
        if len(word) <= 40:
            if len(self) >= HELD:
                self.clear()
            self[word] = out
        return out


_folds = Folds()


def folded(text: str) -> str:
    """A text's words of letters after folding, with a space before and after each; '' without any."""
    words = " ".join(filter(None, map(_folds.__getitem__, text.split())))
    return f" {words} " if words else ""


def folded_parts(text: str) -> Iterator[str]:
    """`folded` of a text in parts of about WINDOW code points, cut at white space where a part has any."""
    first = 0
    while len(text) - first > WINDOW:
        last = max(text.rfind(" ", first, first + WINDOW), text.rfind("\n", first, first + WINDOW))
        last = last if last > first else first + WINDOW
        yield folded(text[first:last])
        first = last
    yield folded(text[first:])


def terms(part: str) -> set[str]:
    """The words of a folded text, and their beginnings of SHORTEST letters or more."""
    out = set()
    for word in set(part.split()):
        out.add(f" {word} ")
        out.update(f" {word[:n]}" for n in range(SHORTEST, min(len(word), LONGEST) + 1))
    return out


@dataclass
class Lexicon:
    """Entries with weights, exception phrases, and the calibration of evidence."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: frozenset[str] = frozenset()
    power: float = 0.5
    slope: float = 1.0
    offset: float = -4.0

    def automaton(self) -> ahocorasick.Automaton | None:
        """Matches entries and exception phrases; None if there is no entry."""
        made = ahocorasick.Automaton()
        for entry in {*self.weights, *self.exceptions}:
            made.add_word(entry, (len(entry), self.weights.get(entry), entry in self.exceptions))
        if self.weights:
            made.make_automaton()
        return made if self.weights else None

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * np.log1p(evidence) + self.offset, -500, 500)))


def matches(part: str, automaton: ahocorasick.Automaton) -> list[tuple[int, int, float]]:
    """(start, end, weight) of the longest entry at each place of a folded text, without those in an exception phrase."""
    best: dict[int, tuple[int, float]] = {}
    spared: list[tuple[int, int]] = []
    for last, (size, weight, exception) in automaton.iter(part):
        start = last - size + 1
        if exception:
            spared.append((start, last + 1))
        if weight is not None and size > best.get(start, (0, 0.0))[0]:
            best[start] = size, weight
    found = [(start, start + size, weight) for start, (size, weight) in sorted(best.items())]
    if not spared or not found:
        return found
    spared.sort()
    out, reach, k = [], -1, 0
    for start, end, weight in found:  # what begins before an entry and reaches furthest decides
        while k < len(spared) and spared[k][0] <= start:
            reach = max(reach, spared[k][1])
            k += 1
        # an entry ends where its last letter ends
        if end - part[start:end].endswith(" ") > reach - (reach > 0 and part[reach - 1] == " "):
            out.append((start, end, weight))
    return out


def evidence(text: str, automaton: ahocorasick.Automaton | None) -> tuple[float, int]:
    """(sum of weights, words) of a text."""
    total, words = 0.0, 0
    for part in folded_parts(text):
        words += max(0, part.count(" ") - 1)
        total += sum(w for _, _, w in matches(part, automaton)) if automaton is not None else 0.0
    return total, words


def normalised(total: np.ndarray, words: np.ndarray, power: float) -> np.ndarray:
    return np.maximum(total, 0) / np.maximum(words / LEAST_WORDS, 1.0) ** power


def around(part: str, start: int, end: int) -> Iterable[str]:
    """The whole word at an entry's place, and the pairs it forms with the word before and the word after."""
    stop = part.index(" ", start + 1) + 1
    yield part[start:stop]
    if start:
        yield part[part.rindex(" ", 0, start) : stop]
    if stop < len(part):
        yield part[start : part.index(" ", stop) + 1]


def counts_of(texts: DataFrame, kinds: Callable[[str], set[str]]) -> DataFrame:
    """(term, toxic, clean): in how many of the labelled texts (text, y) each term occurs. `kinds` gives a text's terms."""

    def run(batches):
        held: dict[int, Counter] = {0: Counter(), 1: Counter()}

        def out():
            both = list({*held[0], *held[1]})
            yield pa.RecordBatch.from_arrays([pa.array(both, pa.string()), *(pa.array([held[y][t] for t in both], pa.int64()) for y in (1, 0))], ["term", "toxic", "clean"])
            held[0].clear()
            held[1].clear()

        for part, _, _ in T.slices(batches):
            for text, y in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                held[y].update(kinds(text or ""))
                if len(held[0]) + len(held[1]) > HELD:
                    yield from out()
        yield from out()

    return texts.mapInArrow(run, "term string, toxic long, clean long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def judged(counts: DataFrame, t: Column, toxic: int, clean: int, ratio: float, gain: float) -> DataFrame:
    """The terms of `counts` that are entries when `t` toxic documents hold them, with their weights and gains."""
    t, c = t.cast("double"), F.col("clean").cast("double")
    rate = toxic / max(1, toxic + clean)
    weight = F.log((t + 0.5) / (toxic + 1.0)) - F.log((c + 0.5) / (clean + 1.0))
    share = lambda x, p: F.when(x > 0, x * F.log(x / ((t + c) * p))).otherwise(0.0)
    return counts.withColumn("weight", weight).withColumn("gain", 2 * (share(t, rate) + share(c, 1 - rate))).where((F.col("weight") >= ratio) & (F.col("gain") >= gain))


def contexts(texts: DataFrame, found: Broadcast) -> DataFrame:
    """(term, contexts): between how many different pairs of neighbouring words each found term occurs."""

    def run(batches):
        held: set[tuple[str, int]] = set()

        def out():
            rows = list(held)
            yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in rows], pa.string()), pa.array([h for _, h in rows], pa.int64())], ["term", "context"])
            held.clear()

        for part, _, _ in T.slices(batches):
            for text in part.column(0).to_pylist():
                for piece in folded_parts(text or ""):
                    words = ["", *piece.split(), ""]
                    for before, word, after in zip(words, words[1:], words[2:]):  # noqa: B905
                        own = [t for t in (f" {word} ", *(f" {word[:n]}" for n in range(SHORTEST, min(len(word), LONGEST) + 1))) if t in found.value]
                        if own:
                            h = crc32(f"{before} {after}".encode())
                            held.update((t, h) for t in own)
                if len(held) > HELD:
                    yield from out()
        yield from out()

    return texts.select("text").mapInArrow(run, "term string, context long").groupBy("term").agg(F.count_distinct("context").alias("contexts"))


def calibrated(bins: np.ndarray, edges: np.ndarray) -> tuple[float, float, float, float]:
    """(power, slope, offset) of the power with the least loss, and the loss. bins[power, bin, label]: numbers of documents."""
    found = []
    for k, power in enumerate(POWERS):
        n = bins[k].sum(1).astype(float) + 1e-9
        y = (bins[k, :, 1] + 1e-9 * 0.1) / n
        x, w = np.log1p(edges), np.array([1.0, -4.0])
        a = np.stack([x, np.ones(len(x))], 1)
        for _ in range(100):  # Newton's steps with a weak pull of the slope to 1
            p = 1 / (1 + np.exp(-np.clip(a @ w, -500, 500)))
            g = a.T @ (n * (p - y)) + np.array([0.5 * (w[0] - 1), 0.01 * (w[1] + 4)])
            h = (a * (n * p * (1 - p))[:, None]).T @ a + np.diag([0.5, 0.01])
            step = np.linalg.solve(h, g)
            w = w - step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        p = np.clip(1 / (1 + np.exp(-np.clip(a @ w, -500, 500))), 1e-9, 1 - 1e-9)
        found.append((-(n * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum(), k, power, w[0], w[1]))
    loss, _, power, slope, offset = min(found)
    return power, float(slope), float(offset), float(loss)


#: Middles of the bins of evidence: none, then a geometric series.
EDGES = np.concatenate([[0.0], 0.01 * 1.25 ** np.arange(BINS - 1)])


def binned(texts: DataFrame, lexicon: Lexicon) -> np.ndarray:
    """Numbers of labelled texts by power, bin and label."""
    held = texts.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches):
        automaton = held.value.automaton()
        out = np.zeros((len(POWERS), BINS, 2), np.int64)
        for part, _, _ in T.slices(batches):
            y = np.array(part.column(1).to_pylist(), np.int64)
            total, words = np.array([evidence(t or "", automaton) for t in part.column(0).to_pylist()]).reshape(-1, 2).T
            for k, power in enumerate(POWERS):
                e = normalised(total, words, power)
                at = np.where(e <= 0, 0, np.clip(np.rint(np.log(np.maximum(e, 1e-9) / EDGES[1]) / np.log(1.25)) + 1, 1, BINS - 1)).astype(int)
                np.add.at(out[k], (at, y), 1)
        where = np.argwhere(out)
        yield pa.RecordBatch.from_arrays([*(pa.array(where[:, i].astype(np.int32)) for i in range(3)), pa.array(out[tuple(where.T)])], ["power", "bin", "label", "n"])

    out = np.zeros((len(POWERS), BINS, 2), np.int64)
    for r in texts.mapInArrow(run, "power int, bin int, label int, n long").groupBy("power", "bin", "label").agg(F.sum("n").alias("n")).collect():  # at most 3 * BINS * 2 rows
        out[r["power"], r["bin"], r["label"]] = r["n"]
    held.destroy()
    return out


def text_terms(text: str) -> set[str]:
    return {t for part in folded_parts(text) for t in terms(part)}


def learned(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_id: str, label_col: str, exceptions: Iterable[str], max_labelled: int, most: int, least_docs: int, ratio: float, gain: float) -> Lexicon:
    """The lexicon of the documents that `labels` marks. The fourth part of the ids is kept for the calibration."""
    context = docs.sparkSession.sparkContext
    said = labels.select(F.col(label_id).alias("__id"), (F.col(label_col) >= 1).cast("int").alias("y")).where("__id IS NOT NULL AND y IS NOT NULL").groupBy("__id").agg(F.max("y").alias("y"))
    said = cut(said)
    whole = 1 << 62
    share = min(whole, whole * max_labelled // max(1, said.count()))
    few = F.broadcast(said.where(F.pmod(F.xxhash64(F.col("__id"), F.lit(12)), F.lit(whole)) < share))  # about max_labelled rows
    fold = F.pmod(F.crc32(F.concat(F.lit("fold:"), F.col("__id").cast("string"))), F.lit(4))
    texts = cut(docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text")).join(few, "__id").select("text", "y", (fold == 0).alias("last")))
    part, rest = texts.where("NOT last").select("text", "y"), texts.where("last").select("text", "y")
    sizes = {r["y"]: r["n"] for r in part.groupBy("y").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    enough = counts_of(part.where("y = 1"), text_terms).where(F.col("toxic") >= least_docs)
    # what max_labelled texts hold bounds the candidates
    candidates = context.broadcast(frozenset(r["term"] for r in enough.select("term").collect()))

    def known(text: str) -> set[str]:
        return text_terms(text) & candidates.value

    weights = {}
    if candidates.value:
        counts = cut(judged(counts_of(part, known), F.col("toxic"), toxic, clean, ratio, gain))
        found = context.broadcast(frozenset(r["term"] for r in counts.select("term").collect()))
        # copies of a text count as one: they have the same words around a term
        apart = counts.join(contexts(part.where("y = 1"), found), "term").where(F.col("contexts") >= least_docs)
        best = judged(apart.drop("weight", "gain"), F.least("toxic", "contexts"), toxic, clean, ratio, gain).orderBy(F.desc("gain"), "term").limit(most)
        weights = {r.term: r.weight for r in best.collect()}
        drop(counts)
    given = frozenset(x for x in map(folded, exceptions) if x)
    spared: set[str] = set()
    if weights:
        held = context.broadcast(Lexicon(weights))
        made: list = []

        def phrases(text: str) -> set[str]:
            if not made:
                made.append(held.value.automaton())
            return {p for x in folded_parts(text) for start, end, _ in matches(x, made[0]) for p in around(x, start, end)}

        weight = F.log((F.col("toxic") + 0.5) / (toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (clean + 1.0))
        kept = counts_of(part, phrases).where(F.col("clean") >= least_docs).where(weight <= HARMLESS)
        spared = {r.term for r in kept.orderBy(F.desc("clean"), "term").limit(most).collect()}
    lexicon = Lexicon(weights, given | spared)
    power, slope, offset, _ = calibrated(binned(rest, lexicon), EDGES)
    drop(said, texts)
    return Lexicon(weights, given | spared, power, slope, offset)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", label_col: str = "toxic", held_out_of: int = 3, held_out_is: int = 1, limit: float = 0.7, exceptions: Iterable[str] = (), max_labelled: int = 60_000, most: int = 5000, least_docs: int = 5, ratio: float = 1.5, gain: float = 25.0) -> DataFrame:
    """(id, held_out, score, predicted, matched, n_words) per row of `docs`; score is the calibrated chance that its label is 1.

    Learned from are the documents whose id has a label and isn't held out, of about `max_labelled` ids by a hash: crc32(id as text) mod `held_out_of` = `held_out_is` is. A null
    id counts as '' and has no label; an id with several labels is toxic if one is. An entry needs `least_docs` toxic documents, a log
    ratio of `ratio` and a likelihood ratio of `gain`; the best `most` are kept, which bounds the broadcast. `exceptions` are phrases in which entries
    don't count. Null, empty and wordless texts have the evidence 0 and the score of a text without matches. Without labels every score is that of the
    starting calibration, below `limit`. Texts may have any length, and a word of more than a million letters counts in parts; rows that repeat an
    id are scored one by one; a score of just `limit` is predicted toxic; other columns play no part; an empty table gives an empty result.
    """
    bounded_batches(docs.sparkSession)
    held_out = lambda x: F.pmod(F.crc32(F.coalesce(x.cast("string"), F.lit(""))), F.lit(held_out_of)) == held_out_is
    lexicon = learned(docs.where(~held_out(F.col(id_col))), labels.where(~held_out(F.col(label_id))), id_col, text_col, label_id, label_col, exceptions, max_labelled, most, least_docs, ratio, gain)
    held = docs.sparkSession.sparkContext.broadcast(lexicon)

    def judge(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        made = held.value
        automaton = made.automaton()
        for texts in columns:
            total, words = np.array([evidence(t or "", automaton) for t in texts.to_pylist()]).reshape(-1, 2).T
            score = made.score(normalised(total, words, made.power))
            yield pa.StructArray.from_arrays([pa.array(score, pa.float64()), pa.array(total, pa.float64()), pa.array(words.astype(np.int64))], ["score", "matched", "n_words"])

    # only texts go to Python and only figures come back
    made = docs.select(F.col(id_col), held_out(F.col(id_col)).alias("held_out"), F.arrow_udf(judge, "score double, matched double, n_words long")(F.col(text_col)).alias("__s"))
    return made.select(id_col, "held_out", "__s.score", (F.col("__s.score") >= limit).cast("int").alias("predicted"), F.col("__s.matched").alias("matched"), "__s.n_words")
