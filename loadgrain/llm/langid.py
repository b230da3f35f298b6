"""Language identification with string kernels.

The kernel of two texts counts the character n-grams (lengths 1 to 4, the
blended spectrum) present in both, over the geometric mean of the numbers
present in each. Kernel ridge regression, one language against the rest, is
solved on Nyström landmarks. Prediction is one matrix product per batch of
texts: the presence matrix times landmark presences folded with coefficients.

N-grams are hashed into a fixed number of slots, so a text of any length costs
one row of that width.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNDETERMINED = "und"
MAX_GRAM = 4
SLOT_BITS = 15
SLOTS = 1 << SLOT_BITS
#: Bound of the labelled sample: rows to fit on over all languages, expected.
FIT_ROWS = 1600
LANDMARKS = 240
RIDGE = 1e-3
#: Texts are scored so many at a time and read so many characters at a time.
BATCH_TEXTS, BATCH_CHARS = 64, 1 << 18
SEED = 6
#: Half way between the targets of a language and of the rest.
LEAST = 0.5

_ODD, _STEP = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B)
_SHIFT = np.uint32(32 - SLOT_BITS)
_folded: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    """Code points as they are compared: letters as they are, all others a space."""
    global _folded
    if _folded is None:
        table = np.full(0x110000, 32, dtype=np.uint32)
        for c in range(0x110000):
            if chr(c).isalpha():
                table[c] = c
        _folded = table
    return _folded


def gram_slots(text: str):
    """Slots of all n-grams of a text, repeats included, one array at a time.

    Letters are lower-cased; what lies between letters counts as one space.
    """
    table = _letter_table()
    tail = np.full(1, 32, dtype=np.uint32)
    for at in range(0, len(text), BATCH_CHARS):
        piece = text[at : at + BATCH_CHARS].lower().encode("utf-32-le", "surrogatepass")
        codes = table[np.frombuffer(piece, dtype="<u4")]
        blank = codes == 32
        # Of blanks in a row, also across stretches, the first counts.
        again = blank & np.concatenate(([tail[-1] == 32], blank[:-1]))
        run = np.concatenate((tail, codes[~again]))
        if at + BATCH_CHARS >= len(text) and run[-1] != 32:
            run = np.append(run, np.uint32(32))
        hashes = run
        for n in range(1, MAX_GRAM + 1):
            if n > 1:
                hashes = hashes[:-1] * _STEP
                hashes += run[n - 1 :]
            if len(hashes) == 0:
                break
            mixed = hashes * _ODD
            mixed ^= mixed >> np.uint32(15)
            mixed *= _STEP
            mixed >>= _SHIFT
            yield mixed
        tail = run[-(MAX_GRAM - 1) :]


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def presence(texts: list[str]) -> np.ndarray:
    """Rows of zeros and ones: which slots occur in which text."""
    rows = np.zeros((len(texts), SLOTS), dtype=np.float32)
    for row, text in zip(rows, texts, strict=True):
        for slots in gram_slots(text):
            row[slots] = 1
    return rows


@dataclass(frozen=True)
class LanguageModel:
    """``weights`` maps a presence row to one sum per language and, last, the row's size."""

    languages: tuple[str, ...]
    weights: np.ndarray

    def decide(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Index of the best language, and its score in 0 to 1."""
        sums = presence(texts) @ self.weights
        scores = sums[:, :-1] / np.sqrt(np.maximum(sums[:, -1:], 1))
        best = scores.argmax(axis=1)
        # Targets are +1 and -1, so this is where between them the best one lies.
        top = scores[np.arange(len(best)), best].astype(np.float64)
        return best, np.clip((top + 1) / 2, 0, 1)


def fit(labelled: DataFrame, fit_rows: int = FIT_ROWS, landmarks: int = LANDMARKS) -> LanguageModel:
    """Fit on ``doc_id``, ``text``, ``lang``; rows without language or letter are passed over.

    The sample is bounded: at most ``fit_rows`` rows, shared evenly by the languages
    (of more languages than that, the most frequent), chosen by a hash of id and text.
    Every language has one row at least. Only the slots that occur leave the executors.
    No rows, or no languages, give a model that knows none.
    """
    slots = 1 << 30
    mark = F.pmod(F.xxhash64(F.col("doc_id"), F.col("text"), F.lit(SEED)), F.lit(slots))
    known = labelled.where("lang IS NOT NULL AND text IS NOT NULL").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang", mark.alias("mark")
    )
    known = known.where(F.col("text").rlike(r"\p{L}"))
    counts = known.groupBy("lang").agg(F.count("*").alias("n"), F.min("mark").alias("first"))
    most = counts.orderBy(F.desc("n"), "lang").limit(fit_rows).collect()
    if not most:
        return LanguageModel((), np.zeros((SLOTS, 1), dtype=np.float32))
    each = max(1, fit_rows // len(most))
    # Somewhat more than is wanted passes by its hash; of that, the smallest stay.
    upto = [(r["lang"], max(r["first"] + 1, min(slots, 1.5 * each / r["n"] * slots))) for r in most]
    shares = F.create_map(*[F.lit(x) for lang, at in upto for x in (lang, float(at))])
    place = F.row_number().over(Window.partitionBy("lang").orderBy("mark", "doc_id"))
    chosen = known.where(F.col("mark") < F.try_element_at(shares, F.col("lang")))
    chosen = chosen.withColumn("place", place).where(F.col("place") <= each)

    def present(batches):
        for frame in batches:
            good = frame[[has_letter(t) for t in frame["text"]]]
            found = [
                np.unique(np.concatenate(list(gram_slots(t)))).astype("<u2").tobytes()
                for t in good["text"]
            ]
            yield pd.DataFrame({"doc_id": good["doc_id"], "lang": good["lang"], "slots": found})

    rows = chosen.select("doc_id", "text", "lang").mapInPandas(
        present, "doc_id bigint, lang string, slots binary"
    )
    rows = sorted((r["lang"], r["doc_id"] or 0, bytes(r["slots"])) for r in rows.collect())
    languages = tuple(sorted({lang for lang, _, _ in rows}))
    if not languages:
        return LanguageModel((), np.zeros((SLOTS, 1), dtype=np.float32))
    seen = [np.frombuffer(x, dtype="<u2") for _, _, x in rows]
    # Landmarks: evenly spaced rows of each language.
    quota = max(1, landmarks // len(languages))
    marks: list[int] = []
    for language in languages:
        own = [i for i, r in enumerate(rows) if r[0] == language]
        marks += own[:: max(1, -(-len(own) // quota))]
    flags = np.zeros((SLOTS, len(marks)), dtype=np.float32)
    for column, i in enumerate(marks):
        flags[seen[i], column] = 1 / np.sqrt(len(seen[i]))
    kernel = np.stack([flags[s].sum(axis=0, dtype=np.float64) / np.sqrt(len(s)) for s in seen])
    target = np.array([[1.0 if r[0] == k else -1.0 for k in languages] for r in rows])
    system = kernel.T @ kernel + RIDGE * len(rows) * kernel[marks] + 1e-8 * np.eye(len(marks))
    coefficients = np.linalg.solve(system, kernel.T @ target)
    folded = flags @ coefficients.astype(np.float32)
    return LanguageModel(languages, np.column_stack((folded, np.ones(SLOTS, dtype=np.float32))))


def predicted(model: LanguageModel, text: Column) -> Column:
    """STRUCT<lang_pred, score> of each text.

    A NULL text, a text without a letter, or a model without languages gives
    ``und`` and 0. Whole texts are read, whatever their length.
    """

    @F.pandas_udf("lang_pred string, score double")
    def run(texts: pd.Series) -> pd.DataFrame:
        names = [UNDETERMINED] * len(texts)
        scores = np.zeros(len(texts))
        usable = [i for i, t in enumerate(texts) if model.languages and has_letter(t)]
        for at in range(0, len(usable), BATCH_TEXTS):
            part = usable[at : at + BATCH_TEXTS]
            best, score = model.decide([texts.iloc[i] for i in part])
            for i, b in zip(part, best, strict=True):
                names[i] = model.languages[b]
            scores[part] = score
        return pd.DataFrame({"lang_pred": names, "score": scores})

    return run(text)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` for every row of ``docs``."""
    return docs.select("doc_id", predicted(model, F.col("text")).alias("p")).select(
        "doc_id", "p.lang_pred", "p.score"
    )


def keep_identified(docs: DataFrame, model: LanguageModel, least: float = LEAST) -> DataFrame:
    """The rows whose language can be told, with the language told in ``lang``.

    A row goes if its text has no letter, or if its best score lies below ``least``:
    then every language's classifier counts it with the rest. Other columns stay as
    they are; without ``lang`` there are no others.
    """
    found, score = (f"__{name}" for name in ("lang_pred", "score"))
    while {found, score} & set(docs.columns):
        found, score = found + "_", score + "_"
    told = docs.withColumn(found, predicted(model, docs["text"]))
    kept = told.where((F.col(found)["lang_pred"] != UNDETERMINED) & (F.col(found)["score"] >= least))
    told_lang = F.col(found)["lang_pred"].alias("lang")
    return kept.select(*[told_lang if c == "lang" else F.col(f"`{c}`") for c in docs.columns])
