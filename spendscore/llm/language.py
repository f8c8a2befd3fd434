"""Language identification by cross-parsing with suffix automata.

For every language an automaton of all substrings of its labelled text is built. A
document is read against each automaton: a phrase is the longest string from the
current place that occurs in the labelled text, and the next phrase starts after it. The
number of phrases, times the bits that naming a place in the labelled text takes, over
the document's length is the cross-entropy that this language would give it; the least wins.
"""

from __future__ import annotations

import functools
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendscore.llm.common import forgettable, held_out, in_training, shipped, tidied, written

#: A language's labelled text: at most so many documents, so many characters of each, and so
#: many characters in all. This bounds the model whatever the table's size; with texts of usual length the last bound
#: acts first, so that 16 beginnings make a language. Shorter pieces of more documents were worse: phrases end where pieces do.
SAMPLE_DOCS, SAMPLE_DOC_CHARS, SAMPLE_CHARS = 80, 1_500, 24_000
#: Letters with a sign of their own, the most frequent over all languages; those beyond share the further signs by a hash, so that
#: scripts of many letters are still told apart. Runs of other characters are a space.
ALPHABET, SHARED = 48, 24
#: Characters parsed as one piece. A phrase ends where a piece does, for every language alike.
PIECE = 512
SPACE = 0
UNDETERMINED = "und"


def suffix_automaton(text: list[int], width: int) -> np.ndarray:
    """Transitions of the automaton of all substrings: state by sign, 0 where there is none."""
    after, link, length, last = [{}], [-1], [0], 0
    for sign in text:
        new = len(after)
        after.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and sign not in after[p]:
            after[p][sign] = new
            p = link[p]
        if p >= 0:
            q = after[p][sign]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                copy = len(after)
                after.append(dict(after[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and after[p].get(sign) == q:
                    after[p][sign] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    table = np.zeros((len(after), width), np.int32)
    for state, moves in enumerate(after):
        if moves:
            table[state, list(moves)] = list(moves.values())
    return table


def parser(table: np.ndarray) -> np.ndarray:
    """One step of the greedy parse per state and sign: the next state, times 4, plus the phrases that end.

    One more sign is added at the end, which changes nothing.
    """
    root = table[0]
    lost = np.where(root > 0, root * 4 + 1, 2)
    steps = np.where(table > 0, table * 4, lost[None, :])
    steps[0] = np.where(root > 0, root * 4, 1)
    return np.concatenate([steps, 4 * np.arange(len(table), dtype=np.int64)[:, None]], axis=1).astype(np.int32)


def shared_sign(codes: np.ndarray) -> np.ndarray:
    """The sign of letters without one of their own."""
    spread = (codes.astype(np.uint64) * np.uint64(0x9E3779B1)) >> np.uint64(7)
    return (ALPHABET + 1 + spread % np.uint64(SHARED)).astype(np.uint8)


class Model:
    """Automata of the languages over one alphabet, from labelled text."""

    def __init__(self, samples: dict[str, str]):
        letters = Counter(c for text in samples.values() for c in text.lower() if c.isalpha() and ord(c) < 65536)
        self.signs = np.full(65536, SPACE, np.uint8)
        self.letter = np.array([chr(c).isalpha() for c in range(65536)])
        self.signs[self.letter] = shared_sign(np.flatnonzero(self.letter))
        for k, (c, _) in enumerate(sorted(letters.items(), key=lambda x: (-x[1], x[0]))[:ALPHABET]):
            self.signs[ord(c)] = k + 1
        self.width = ALPHABET + SHARED + 1
        self.languages = sorted(samples)
        self.steps, self.bits = [], []
        for language in self.languages:
            text = self.read(samples[language])[0]
            self.steps.append(parser(suffix_automaton(text.tolist(), self.width)).ravel())
            self.bits.append(np.log2(max(2, len(text))))

    def read(self, text: str | None) -> tuple[np.ndarray, bool]:
        """The signs of a text, runs of spaces as one, and whether it has a letter."""
        text = (text or "").lower()
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        high = codes > 65535
        codes = np.where(high, 0, codes)
        signs = self.signs[codes]
        letters = bool(self.letter[codes].any())
        if high.any():
            far = np.array([c.isalpha() for c in text])
            signs = np.where(high & far, shared_sign(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)), signs)
            letters = letters or bool(far.any())
        keep = np.ones(len(signs), bool)
        keep[1:] = (signs[1:] != SPACE) | (signs[:-1] != SPACE)
        return signs[keep], letters

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases of every text (rows) by every language (columns); pieces of all texts side by side."""
        pieces = [(k, t[i : i + PIECE]) for k, t in enumerate(texts) for i in range(0, len(t), PIECE)]
        pieces.sort(key=lambda x: -len(x[1]))
        sizes = np.array([len(p) for _, p in pieces])
        owner = np.array([k for k, _ in pieces], np.int64)
        out = np.zeros((len(texts), len(self.languages)), np.int64)
        if not pieces:
            return out
        grid = np.zeros((sizes[0], len(pieces)), np.int32)
        for k, (_, p) in enumerate(pieces):
            grid[: len(p), k] = p
        active = np.searchsorted(-sizes, -np.arange(sizes[0]), side="left")  # pieces longer than j
        width = self.width + 1
        for column, steps in enumerate(self.steps):
            state = np.zeros(len(pieces), np.int32)
            count = np.zeros(len(pieces), np.int32)
            for j in range(sizes[0]):
                n = active[j]
                step = steps[state[:n] * width + grid[j, :n]]
                count[:n] += step & 3
                state[:n] = step >> 2
            np.add.at(out[:, column], owner, count + (state > 0))
        return out

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, float]]:
        """(language, score, bits a character) per text. Ties go to the language that sorts first."""
        return [found[:3] for found in self.judged(texts)]

    def judged(self, texts: list[str | None]) -> list[tuple[str, float, float, float]]:
        """What ``predict`` gives, and the bits without those of one phrase: that which the text's end cuts short."""
        read = [self.read(t) for t in texts]
        counts = self.phrases([signs for signs, _ in read])
        out = []
        for (signs, letters), found in zip(read, counts):
            if not letters or not self.languages:
                out.append((UNDETERMINED, 0.0, 0.0, 0.0))
                continue
            rates = found * np.array(self.bits) / len(signs)
            order = np.argsort(rates, kind="stable")
            best = rates[order[0]]
            score = 1.0 if len(order) == 1 else 1 - best / rates[order[1]]
            phrases = found[order[0]]
            out.append((self.languages[order[0]], float(min(1.0, max(0.0, score))), float(best), float(best * (phrases - 1) / phrases)))
        return out


@functools.lru_cache(maxsize=1)
def _model(samples: tuple[tuple[str, str], ...]) -> Model:
    return Model(dict(samples))


forgettable(__name__, _model.cache_clear)


def learned_samples(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    most_docs: int = SAMPLE_DOCS,
    doc_chars: int = SAMPLE_DOC_CHARS,
    most_chars: int = SAMPLE_CHARS,
) -> tuple[tuple[str, str], ...]:
    """(language, labelled text) from a bounded, repeatable choice of the training rows.

    Rows are chosen by a hash of the id. Counts per language come first, so that only about four
    times the rows wanted are ever ordered.
    """
    known = docs.where(in_training(id_col) & F.col(lang_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"),
        F.xxhash64(F.lit("language"), id_col).alias("draw"),
    )
    shares = known.groupBy("lang").agg(F.least(F.lit(1.0), F.lit(4.0 * most_docs) / F.count(F.lit(1))).alias("share"))
    shares = written(shares, "shares")  # a row a language; its size is known when the join is planned
    near = known.join(shares, "lang").where(F.pmod("draw", F.lit(1_000_000)) < F.col("share") * 1_000_000)
    turn = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("draw", F.lit(1_000_000)), "id", "text"))
    rows = (
        near.withColumn("text", F.substring("text", 1, doc_chars)).where("length(text) > 0")
        .withColumn("turn", turn).where(F.col("turn") <= most_docs).select("lang", "turn", "text").collect()
    )
    texts: dict[str, list[str]] = {}
    for row in sorted(rows, key=lambda r: (r["lang"], r["turn"])):
        texts.setdefault(row["lang"], []).append(row["text"])
    return tuple((lang, " ".join(parts)[:most_chars]) for lang, parts in sorted(texts.items()))


def typical_bits(samples: tuple[tuple[str, str], ...]) -> dict[str, float]:
    """Bits a character that a language's labelled text takes if only the other half of it is known."""
    out = {}
    for language, text in samples:
        half = len(text) // 2
        halves = [text[:half], text[half:]]
        rates = [Model({language: known}).judged([other])[0] for known, other in (halves, halves[::-1])]
        if all(found[0] != UNDETERMINED for found in rates):
            out[language] = sum(found[2] for found in rates) / 2
    return out


@tidied
def _predicted(batches, samples, typical):
    model = _model(samples.value)
    for pdf in batches:
        for start in range(0, len(pdf), 2000):
            part = pdf.iloc[start : start + 2000]
            found = model.judged(part["text"].tolist())
            yield pd.DataFrame({
                "id": part["id"], "held_out": part["held_out"], "lang_pred": [x[0] for x in found],
                "score": [x[1] for x in found], "bits": [x[2] for x in found], "excess": [x[3] for x in found],
                "typical": [typical.value.get(x[0]) for x in found],
            })


def languages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **sample
) -> DataFrame:
    """Per row: ``id_col``, ``held_out``, ``lang_pred``, ``score`` and ``bits``.

    ``lang_pred`` is a language of the training rows, or ``und`` for NULL text, text without
    a letter, and where no language could be learned; the score, 1 less the winner's phrases over
    those of the runner-up, is then 0. ``bits`` are the winner's bits a character.

    * Whole texts are parsed, of any length. Ties go to the language that sorts first.
    * Repeated rows get equal results; rows without id are held out.
    * An empty table gives no rows; further columns are ignored.
    """
    return judged_languages(docs, id_col, text_col, lang_col, **sample).drop("excess", "typical")


def judged_languages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **sample
) -> DataFrame:
    """``languages``, with ``excess``, the bits a character without one phrase's, and ``typical``, those of the winner's labelled texts."""
    spark = shipped(docs.sparkSession)
    learned = learned_samples(docs, id_col, text_col, lang_col, **sample)
    samples, typical = spark.sparkContext.broadcast(learned), spark.sparkContext.broadcast(typical_bits(learned))
    kind = docs.schema[id_col].dataType.simpleString()
    found = docs.select(
        F.col(id_col).cast("string").alias("id"), held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("text"),
    ).mapInPandas(
        functools.partial(_predicted, samples=samples, typical=typical),
        "id string, held_out boolean, lang_pred string, score double, bits double, excess double, typical double",
    )
    return found.withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", id_col)
