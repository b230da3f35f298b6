"""SentencePiece encoding and decoding: Aho-Corasick over the pieces, single-pass Viterbi.

The best segmentation is the one with the largest sum of piece scores. The
automaton names, at each position, all pieces that end there (it follows output
links, longest first), and each relaxes the best score of that position. Equal
sums keep the longer last piece. Characters that are no piece fall back to byte
pieces.

No piece runs on into the next word, so words are segmented apart, and a Python
worker remembers those it has met.
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
#: Words a Python worker remembers, in each of two generations.
REMEMBERED = 100_000
#: Longer words (texts without spaces are one) are not remembered, so memory has a bound in bytes.
LONGEST = 64


class Pieces:
    """The pieces of a model file and the automaton over them.

    The file is read by the library, which is asked for pieces and scores only.
    Text is taken as it is (identity normalisation), with one space put before.
    """

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        self.text = [model.id_to_piece(i) for i in range(n)]
        plain = [
            i
            for i in range(n)
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        self.scores = {self.text[i]: (model.get_score(i), i) for i in plain}
        self.unknown = model.unk_id()
        self.byte_ids = {int(self.text[i][3:5], 16): i for i in range(n) if model.is_byte(i)}
        self.is_byte = np.zeros(n, dtype=bool)
        self.is_byte[list(self.byte_ids.values())] = True
        self.raw = [
            bytes([int(t[3:5], 16)]) if self.is_byte[i] else t.replace(SPACE, " ").encode()
            for i, t in enumerate(self.text)
        ]
        for i in range(n):
            if model.is_control(i):
                self.raw[i] = b""
        if any(SPACE in p.lstrip(SPACE) for p in self.scores):
            raise ValueError("a piece runs across words; this model can't be split by words")
        automaton = ahocorasick.Automaton()
        for piece, (score, i) in self.scores.items():
            automaton.add_word(piece, (len(piece), score, i))
        automaton.make_automaton()
        self.matches = automaton.iter
        singles = "".join(re.escape(p) for p in self.scores if len(p) == 1)
        # Runs of characters that are pieces, split where a word starts; other characters apart.
        space = re.escape(SPACE)
        covered = f"[{singles}]" if singles else "(?!)"
        inner = f"(?:(?!{space}){covered})"
        self.runs = re.compile(f"{space}+{inner}*|{inner}+|.", re.S).findall if SPACE in self.scores else None
        if self.runs is None:
            raise ValueError("the model has no piece for a space")
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def viterbi(self, run: str) -> list[int]:
        """Ids of the best segmentation of a run whose characters are all pieces."""
        best = [0.0] + [float("-inf")] * len(run)
        back = [(0, 0)] * (len(run) + 1)
        for last, (size, score, i) in self.matches(run):
            total = best[last + 1 - size] + score
            if total > best[last + 1]:
                best[last + 1] = total
                back[last + 1] = (size, i)
        ids, at = [], len(run)
        while at:
            size, i = back[at]
            ids.append(i)
            at -= size
        return ids[::-1]

    def _word(self, word: str) -> bytes:
        """Ids of a word with its leading space marks, as little-endian unsigned ints."""
        ids: list[int] = []
        for run in self.runs(word):
            if len(run) > 1 or run in self.scores:
                ids += self.viterbi(run)
            elif self.byte_ids:
                ids += [self.byte_ids[b] for b in run.encode("utf-8", "surrogatepass")]
            else:
                ids.append(self.unknown)
        return np.array(ids, dtype="<u4").tobytes()

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text; none for NULL or an empty one."""
        if not text:
            return np.zeros(0, dtype="<u4")
        words = text.replace(SPACE, " ").split(" ")
        if "" in words:
            marked = SPACE + text.replace(" ", SPACE)
            words = [w[1:] for w in re.findall(f"{SPACE}+[^{SPACE}]*", marked)]
        young, found = self.young, []
        for word in words:
            known = young.get(word)
            if known is None:
                known = self.old.get(word)
                if known is None:
                    known = self._word(SPACE + word)
                if len(word) <= LONGEST:
                    young[word] = known
                    if len(young) > REMEMBERED:
                        self.young, self.old = {}, young
                        young = self.young
            found.append(known)
        return np.frombuffer(b"".join(found), dtype="<u4")

    def decode(self, ids: np.ndarray) -> str:
        """The text of a sequence of ids; the space put before it is taken off."""
        raw = self.raw
        joined = b"".join([raw[i] for i in ids.tolist()])
        return joined.decode("utf-8", "replace").removeprefix(" ")


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def encode_documents(docs: DataFrame, model: str, with_ids: bool = True) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_tokens``, ``n_bytes_fallback``,
    ``ids_crc32`` (ids as little-endian unsigned 32-bit integers), ``round_trip``
    (whether decoding the ids gives the text back) and, if asked for, ``ids``.

    A NULL text counts as empty, which has no ids. The mark U+2581 stands for a
    space in the model, so a text that holds it comes back with spaces.
    """

    def run(batches):
        own = pieces(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = [t or "" for t in batch.column(1).slice(at, 256).to_pylist()]
                ids = [own.encode(t) for t in part]
                columns = [
                    batch.column(0).slice(at, 256),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([int(own.is_byte[x].sum()) for x in ids], pa.int64()),
                    pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                    pa.array(
                        [own.decode(x) == t for x, t in zip(ids, part, strict=True)], pa.bool_()
                    ),
                ]
                names = ["doc_id", "n_tokens", "n_bytes_fallback", "ids_crc32", "round_trip"]
                if with_ids:
                    columns.append(pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = (
        "doc_id bigint, n_tokens bigint, n_bytes_fallback bigint, ids_crc32 bigint, "
        "round_trip boolean" + ", ids array<int>" * with_ids
    )
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string")
    ).mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, model: str) -> DataFrame:
    """``doc_id`` and ``text`` from ``doc_id`` and ``ids``; NULL ids count as none."""

    def run(batches):
        own = pieces(model)
        for batch in batches:
            texts = [own.decode(np.array(x or [], dtype=np.int64)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"]
            )

    return encoded.select(F.col("doc_id").cast("bigint"), "ids").mapInArrow(
        run, "doc_id bigint, text string"
    )
