"""Language identification by hyperdimensional profiles of letter trigrams."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.memory import remember_only

DIMENSIONS = 1024
SEED = 20_240_601
#: Documents whose counts stand in one matrix, and trigram vectors that a worker remembers.
BLOCK = 64
REMEMBERED_TRIGRAMS = 32_768

UNDETERMINED = "und"

#: A text is held against chance if it has so many different trigrams, and if one of its language would reach such a cosine.
LEAST_TRIGRAMS = 24
LEAST_EXPECTED = 0.25


class Prototypes(dict):
    """Unit vectors by language; ``spread`` has for each the chance that two of its trigrams are the same."""

    def __init__(self, vectors: dict[str, np.ndarray] = {}, spread: dict[str, float] = {}):
        super().__init__(vectors)
        self.spread = dict(spread)


def chance(n: float, spread: float) -> float:
    """The cosine that text of ``n`` different trigrams must exceed to resemble a language of this spread; -1 for any.

    Unrelated text gives 0 with a deviation of 1 / sqrt(DIMENSIONS) for each language. Random text of a language's letters gives more,
    the longer the more, but less than two fifths of what its texts give.
    """
    expected = np.sqrt(n * spread / (1 + n * spread))
    if n < LEAST_TRIGRAMS or expected < LEAST_EXPECTED:
        return -1.0
    noise = 3.2 / np.sqrt(DIMENSIONS)
    return float(max(noise, min(0.4 * expected, noise * (n / 32) ** 0.4)))


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


@lru_cache(maxsize=8192)
def letter_vector(code: int) -> np.ndarray:
    """The random vector of +1 and -1 of a letter; it depends on the code point alone."""
    return np.random.Generator(np.random.PCG64([SEED, code])).integers(0, 2, DIMENSIONS, dtype=np.int8) * 2 - 1


def trigram_keys(text: str) -> np.ndarray:
    """The trigrams of the lower-cased letters, one integer each; whatever lies between letters counts as one blank.

    A text without letters has none.
    """
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    letters = _letters()[codes]
    if not letters.any():
        return np.empty(0, dtype=np.int64)
    codes = np.where(letters, codes, 32).astype(np.int64)
    keep = letters | np.concatenate(([True], letters[:-1]))
    codes = np.concatenate(([32], codes[keep], [32]))
    codes = codes[np.concatenate(([True], (codes[1:] != 32) | (codes[:-1] != 32)))]
    return codes[:-2] << 42 | codes[1:-1] << 21 | codes[2:]


class TrigramVectors:
    """Trigram vectors: the letters' vectors, rolled by their place, multiplied."""

    def __init__(self):
        self.row: dict[int, int] = {}
        self.table = np.empty((1024, DIMENSIONS), dtype=np.int8)  # a quarter of what floats would take

    def of(self, keys: np.ndarray) -> np.ndarray:
        if len(self.row) + len(keys) > REMEMBERED_TRIGRAMS:
            self.__init__()
        rows = np.empty(len(keys), dtype=np.int64)
        for i, key in enumerate(keys.tolist()):
            row = self.row.get(key)
            if row is None:
                row = self.row[key] = len(self.row)
                if row >= len(self.table):
                    self.table = np.concatenate((self.table, np.empty_like(self.table)))
                first, second, third = (letter_vector(key >> shift & 0x1FFFFF) for shift in (42, 21, 0))
                self.table[row] = np.roll(first, 2) * np.roll(second, 1) * third
            rows[i] = row
        return self.table[rows].astype(np.float32)


@lru_cache(maxsize=1)
def _vectors() -> TrigramVectors:
    return TrigramVectors()


def _bundles(groups: list[list[np.ndarray]]) -> np.ndarray:
    """One bundled vector for each group of trigram keys: the sum over all its trigrams."""
    sizes = [sum(map(len, group)) for group in groups]
    keys = np.concatenate([part for group in groups for part in group] or [np.empty(0, dtype=np.int64)])
    out = np.zeros((len(groups), DIMENSIONS), dtype=np.float64)
    if not len(keys):
        return out
    codes, letter = np.unique(keys & 0x1FFFFF, return_inverse=True)
    if len(codes) <= 64:  # a small alphabet: number the trigrams by counting instead of sorting
        lookup = np.zeros(int(max(codes.max(), (keys >> 42).max(), (keys >> 21 & 0x1FFFFF).max())) + 1, dtype=np.int64)
        known = np.unique(np.concatenate((codes, np.unique(keys >> 42), np.unique(keys >> 21 & 0x1FFFFF))))
        lookup[known] = np.arange(len(known))
        n = len(known)
        short = (lookup[keys >> 42] * n + lookup[keys >> 21 & 0x1FFFFF]) * n + lookup[keys & 0x1FFFFF]
        seen = np.bincount(short, minlength=n**3) > 0
        distinct_short = np.flatnonzero(seen)
        column = (np.cumsum(seen) - 1)[short]
        distinct = known[distinct_short // n**2] << 42 | known[distinct_short // n % n] << 21 | known[distinct_short % n]
    else:
        distinct, column = np.unique(keys, return_inverse=True)
    owner = np.repeat(np.arange(len(groups)), sizes)
    # The columns come in steps, so that memory is bounded whatever the number of distinct trigrams.
    step = REMEMBERED_TRIGRAMS // 8
    for start in range(0, len(distinct), step):
        part = distinct[start : start + step]
        if len(distinct) > step:
            inside = (column >= start) & (column < start + step)
            cells = owner[inside] * len(part) + column[inside] - start
        else:
            cells = owner * len(part) + column
        counts = np.bincount(cells, minlength=len(groups) * len(part)).reshape(len(groups), -1)
        out += counts.astype(np.float32) @ _vectors().of(part)
    return out


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of all trigram vectors of each language in this task, and behind it their number."""
    remember_only(_vectors.cache_clear)
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            part = batch.slice(start, BLOCK)
            groups: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                groups.setdefault(lang, []).append(trigram_keys(text))
            for (lang, keys), bundle in zip(groups.items(), _bundles(list(groups.values()))):
                sums[lang] = sums.get(lang, 0.0) + np.append(bundle, sum(map(len, keys)))
    langs = sorted(sums)
    yield pa.RecordBatch.from_arrays(
        [pa.array(langs, pa.string()), pa.array([sums[lang] for lang in langs], pa.list_(pa.float64()))], names=["lang", "bundle"]
    )


def learn_prototypes(docs: DataFrame, text_column: str = "text", lang_column: str = "lang") -> Prototypes:
    """A unit vector for each language from all rows with text and lang.

    Every task adds up its own texts and sends one vector per language. The sums are whole numbers, so
    their order does not matter. What reaches the driver is one vector of ``DIMENSIONS`` numbers per language.
    Languages whose texts have no letters get no prototype; without rows the result is empty.
    """
    rows = docs.select(F.col(text_column).alias("text"), F.col(lang_column).alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    partial_sums = rows.mapInArrow(_train, "lang string, bundle array<double>")
    summed = partial_sums.select("lang", F.posexplode("bundle").alias("place", "value")).groupBy("lang", "place").agg(F.sum("value").alias("value"))
    bundles = summed.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "value"))).alias("bundle"))
    prototypes, spread = {}, {}
    for row in bundles.select("lang", "bundle.value").collect():
        *vector, n = row["value"]
        if norm := np.linalg.norm(vector):
            prototypes[row["lang"]] = np.array(vector) / norm
            spread[row["lang"]] = float(norm**2 / DIMENSIONS / n**2)
    return Prototypes(dict(sorted(prototypes.items())), spread)


def _scored(texts: list[str | None], langs: list[str], prototypes: np.ndarray) -> Iterator[tuple[str, float, float]]:
    """For each text its language, the cosine with it, and how many trigrams would have its norm if all were different."""
    keys = [trigram_keys(text or "") for text in texts]
    bundles = _bundles([[k] for k in keys])
    norms = np.linalg.norm(bundles, axis=1)
    cosines = bundles @ prototypes.T / np.maximum(norms, 1e-300)[:, None]
    best = cosines.argmax(axis=1) if len(langs) else np.zeros(len(keys), dtype=int)
    for k, norm, row, b in zip(keys, norms, cosines, best):
        if len(langs) > 0 and norm > 0:
            yield langs[b], float(row[b]), len(k) ** 2 * DIMENSIONS / norm**2
        else:
            yield UNDETERMINED, 0.0, 0.0


def _predict(batches: Iterator[pa.RecordBatch], model: bytes) -> Iterator[pa.RecordBatch]:
    remember_only(_vectors.cache_clear)
    langs, prototypes, _ = pickle.loads(model)
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            part = batch.slice(start, BLOCK)
            found = list(_scored(part.column("text").to_pylist(), langs, prototypes))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array([lang for lang, _, _ in found], pa.string()),
                    pa.array([float(np.clip(cosine, 0.0, 1.0)) for _, cosine, _ in found], pa.float64()),
                ],
                names=["doc_id", "lang_pred", "score"],
            )


def _known(batches: Iterator[pa.RecordBatch], model: bytes, text_column: str, least: float, beyond_chance: bool) -> Iterator[pa.RecordBatch]:
    remember_only(_vectors.cache_clear)
    langs, prototypes, spread = pickle.loads(model)

    def known(lang: str, cosine: float, n: float) -> bool:
        resembles = not beyond_chance or cosine > chance(n, spread.get(lang, 0.0))
        return lang != UNDETERMINED and max(cosine, 0.0) >= least and resembles

    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            part = batch.slice(start, BLOCK)
            keep = [known(*found) for found in _scored(part.column(text_column).to_pylist(), langs, prototypes)]
            yield part.filter(pa.array(keep, pa.bool_()))


def keep_known_languages(
    docs: DataFrame, prototypes: dict[str, np.ndarray], least: float, text_column: str = "text", beyond_chance: bool = False
) -> DataFrame:
    """The rows of ``docs`` whose text has a language with a score of ``least`` or more, as they are; no shuffle.

    With ``beyond_chance``, for which ``prototypes`` must come from ``learn_prototypes``, texts that resemble their language no more
    than random text of that length would go too (``chance``); those too short to tell stay.
    """
    keep = partial(_known, model=_model(prototypes), text_column=text_column, least=least, beyond_chance=beyond_chance)
    return docs.mapInArrow(keep, docs.schema)


def _model(prototypes: dict[str, np.ndarray]) -> bytes:
    langs = list(prototypes)
    vectors = np.array([prototypes[lang] for lang in langs]).reshape(len(langs), DIMENSIONS)
    return pickle.dumps((langs, vectors, getattr(prototypes, "spread", {})))


def predict_languages(docs: DataFrame, prototypes: dict[str, np.ndarray], id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, lang_pred, score (cosine with the best prototype, 0 to 1).

    The whole text is bundled; there is no shuffle. Null, empty and letterless texts, and every text if there are no
    prototypes, give ``und`` with score 0. Equal cosines go to the language first in alphabetical order. Null ids
    stay null, repeated rows give repeated rows, other columns are ignored.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(partial(_predict, model=_model(prototypes)), "doc_id long, lang_pred string, score double")
