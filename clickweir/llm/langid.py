"""Language identification with a blended-spectrum presence kernel.

A text is the set of byte n-grams of 1 to 3 bytes that it holds, ASCII letters in lower
case. Grams count as far as a landmark text has them; k(x, y) is the number of shared grams over the
geometric mean of both numbers. The kernels with the landmarks are one matrix product for
a batch of texts; Nyström features follow from them by another, and one-versus-rest ridge
regression in these features gives a score per language.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from clickweir.llm.utf8 import LOWER, owner, pieces
from clickweir.llm.workers import releasing
from clickweir.session import stored

PER_LANGUAGE = 300    # texts of a language that are learned from: those of the smallest id hashes
LANDMARKS = 96        # dealt evenly to the languages
RIDGE = 1e-3
LONGEST = 3           # bytes of a gram
BATCH_ROWS = 64       # texts of one matrix product
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
_SHIFT = [0, 1 << 8, (1 << 8) + (1 << 16)]     # where the codes of 1, 2 and 3 bytes begin
CODES = (1 << 8) + (1 << 16) + (1 << 24)


def _grams(data: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, gram code) of all grams of a piece, by length."""
    low = LOWER[data].astype("i4")
    text = owner(starts)
    code = low
    for n in range(LONGEST):
        if n:
            code = (code[:-1] << 8) | low[n:]
        if not len(code):
            return
        inside = text[:len(code)] == text[n:]
        yield text[:len(code)][inside], code[inside] + _SHIFT[n]


@dataclass
class Model:
    languages: list[str]
    number: np.ndarray     # gram code of every known gram, ascending
    landmarks: np.ndarray  # grams x landmarks, scaled
    features: np.ndarray   # landmarks x landmarks
    weights: np.ndarray    # landmarks x languages

    def presence(self, data: np.ndarray, starts: np.ndarray, table: np.ndarray) -> np.ndarray:
        """Texts x known grams; `table` gives a code's place or one past the last."""
        n, d = len(starts) - 1, len(self.number) + 1
        out = np.zeros(n * d, "f4")
        for text, code in _grams(data, starts):
            out[text * d + table[code]] = 1
        return out.reshape(n, d)[:, :-1]

    def table(self) -> np.ndarray:
        out = np.full(CODES, len(self.number), "u2" if len(self.number) < 1 << 16 else "i4")
        out[self.number] = np.arange(len(self.number))
        return out

    def kernel(self, presence: np.ndarray) -> np.ndarray:
        norm = np.sqrt(presence.sum(axis=1))
        return (presence @ self.landmarks) / np.maximum(norm, 1)[:, None]

    def scores(self, data: np.ndarray, starts: np.ndarray, table: np.ndarray) -> np.ndarray:
        return self.kernel(self.presence(data, starts, table)) @ self.features @ self.weights


def _small(texts: list[str], rows: int = BATCH_ROWS):
    for at in range(0, len(texts), rows):
        for _, data, starts in pieces(pa.array(texts[at:at + rows], pa.string())):
            yield data, starts


def gram_codes(text: str) -> np.ndarray:
    """The grams that a text has, as ascending codes."""
    return np.unique(np.concatenate([np.zeros(0, "i4"), *[code for data, starts in _small([text]) for _, code in _grams(data, starts)]]))


def fit(texts: list[str], languages: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    return fit_codes([gram_codes(t) for t in texts], languages, landmarks, ridge)


def fit_codes(codes: list[np.ndarray], languages: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """A model of texts given by their grams. Landmarks are the first texts of each language in turn; the model is a few MB."""
    names = sorted(set(languages))
    each = -(-landmarks // max(1, len(names)))
    taken: dict[str, int] = {}
    marks = []
    for some, lang in zip(codes, languages):
        if taken.setdefault(lang, 0) < each:
            taken[lang] += 1
            marks.append(some)
    known = np.unique(np.concatenate([np.zeros(0, "i4"), *marks]))
    model = Model(names, known, np.zeros((len(known), 0), "f4"), np.zeros((0, 0)), np.zeros((0, len(names))))
    if not len(known):
        return model
    table = model.table()

    def presence(some: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(some), len(known) + 1), "f4")
        for row, c in zip(out, some):
            row[table[c]] = 1
        return out[:, :-1]

    seen = presence(marks)
    seen = seen[seen.sum(axis=1) > 0]
    model.landmarks = np.ascontiguousarray((seen / np.sqrt(seen.sum(axis=1))[:, None]).T)
    values, vectors = np.linalg.eigh((model.landmarks.T @ model.landmarks).astype("f8"))
    values = np.where(values > 1e-6, values, np.inf)
    model.features = vectors / np.sqrt(values)
    rows = np.concatenate([model.kernel(presence(codes[at:at + BATCH_ROWS])) for at in range(0, len(codes), BATCH_ROWS)]) @ model.features
    target = np.where(np.array(languages)[:, None] == np.array(names)[None, :], 1.0, -1.0)
    # rows of a rare language weigh as much in sum as those of others
    share = np.array([1 / languages.count(x) for x in names])[[names.index(x) for x in languages]]
    weighted = rows * share[:, None]
    model.weights = np.linalg.solve(weighted.T @ rows + ridge * np.eye(rows.shape[1]), weighted.T @ target)
    return model


def training_rows(docs: DataFrame, learn: Column, id_col: str, text_col: str, lang_col: str, per_language: int) -> DataFrame:
    """text, lang, order of at most so many texts of each language, those of the smallest id hashes.

    Only hashes are ordered; the texts are read for the chosen ones alone.
    """
    order, tie = F.xxhash64(F.col(id_col)), F.xxhash64(F.col(text_col))
    usable = docs.filter(learn & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    first = Window.partitionBy("c_lang").orderBy("c_order", "c_tie")
    chosen = (usable.select(F.col(lang_col).alias("c_lang"), order.alias("c_order"), tie.alias("c_tie"))
              .withColumn("place", F.row_number().over(first)).filter(F.col("place") <= per_language)
              .drop("place").distinct())
    chosen = stored(chosen, "chosen-texts")     # of known size, so that Spark broadcasts it only if small
    return (usable.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), order.alias("order"), tie.alias("tie"))
            .join(chosen, (F.col("lang") == F.col("c_lang")) & (F.col("order") == F.col("c_order")) & (F.col("tie") == F.col("c_tie")))
            .dropDuplicates(["lang", "order", "tie"]).select("text", "lang", "order"))


def identify(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             per_language: int = PER_LANGUAGE, landmarks: int = LANDMARKS) -> DataFrame:
    """doc_id, lang_pred, score: one row per row of `docs`, whose `learn` rows give the labels.

    Text that is null or has no letter: `und`, score 0; the same for all if nothing can be
    learned. Equal scores go to the first language by code point. Repeated rows and ids count as rows; null
    labels are not learned from. Whole texts are read. An empty table gives no rows. Only
    the text enters a prediction; other columns are not read. The score is (f + 1) / 2 of the best language's
    regression f to +1 and -1, held to 0 and 1.
    """
    chosen = training_rows(docs, F.coalesce(learn, F.lit(False)), id_col, text_col, lang_col, per_language)

    def count(batches):
        for batch in batches:
            codes = [gram_codes(t.as_py()).astype("<i4").tobytes() for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(codes, pa.binary())], ["lang", "order", "codes"])

    # of each text only which grams it has, and at most per_language texts of each language
    rows = chosen.select("lang", "order", "text").mapInArrow(releasing(count), "lang string, order bigint, codes binary").collect()
    rows.sort(key=lambda r: (r.order, r.lang, bytes(r.codes)))
    model = fit_codes([np.frombuffer(r.codes, "<i4") for r in rows], [r.lang for r in rows], landmarks)

    def run(batches):
        table = model.table()
        for batch in batches:
            texts = batch.column(1)
            names, best = [], []
            for rows, data, starts in pieces(texts, 1 << 18, BATCH_ROWS):
                strings = texts[rows].to_pylist()
                known = [bool(model.languages and t and _LETTER.search(t)) for t in strings]
                score = model.scores(data, starts, table) if any(known) else np.zeros((len(strings), 1))
                for ok, row in zip(known, score):
                    at = int(row.argmax()) if ok else 0
                    names.append(model.languages[at] if ok else UNKNOWN)
                    best.append(float(np.clip((row[at] + 1) / 2, 0, 1)) if ok else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(best, pa.float64())],
                                             ["doc_id", "lang_pred", "score"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string")).mapInArrow(
        releasing(run), "doc_id bigint, lang_pred string, score double")
