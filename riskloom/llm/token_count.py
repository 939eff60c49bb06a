"""Token counts of whole texts: Arrow batches in, lengths out."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import text_or_empty

# A space that does not follow white space starts a new piece, whatever comes
# before it: no vocabulary entry has a space after another character.
CUT = re.compile(r"(?<=[^ ▁]) (?=.)", re.DOTALL)
KEPT = 300_000
_counters: dict[int, Counter] = {}


class Counter:
    """Lengths by the sentencepiece library; lengths of frequent segments are kept."""

    def __init__(self, model: bytes, batch_bytes: int):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.batch_bytes = batch_bytes
        pieces = map(self.model.IdToPiece, range(self.model.GetPieceSize()))
        self.safe = not any("▁" in p[1:] and p.strip("▁") for p in pieces)
        self.kept: dict[str, int] = {}

    def segments(self, text: str) -> list[str]:
        if not self.safe:
            return [text]
        if "  " in text or "▁" in text or text[:1] == " " or text[-1:] == " ":
            return CUT.split(text)
        return text.split(" ")

    def learn(self, texts: list[list[str]]) -> None:
        """Encode what is new in batches of about the same number of bytes."""
        new = [s for s in dict.fromkeys(s for t in texts for s in t) if s not in self.kept]
        if len(self.kept) + len(new) > KEPT:
            self.kept.clear()
            new = list(dict.fromkeys(s for t in texts for s in t))
        batch, size = [], 0
        for i, segment in enumerate(new):
            batch.append(segment)
            size += len(segment.encode())
            if size >= self.batch_bytes or i == len(new) - 1:
                self.kept.update(zip(batch, map(len, self.model.encode(batch, num_threads=1)), strict=True))
                batch, size = [], 0

    def count(self, texts: list[str]) -> list[int]:
        out, group, size = [], [], 0
        for i, text in enumerate(texts):
            group.append(self.segments(text))
            size += len(text)
            if size >= self.batch_bytes or i == len(texts) - 1:
                self.learn(group)
                out += [sum(map(self.kept.__getitem__, s)) if s != [""] else 0 for s in group]
                group, size = [], 0
        return out


def _counter(model: bytes, batch_bytes: int) -> Counter:
    key = hash((model, batch_bytes))
    if key not in _counters:
        _counters[key] = Counter(model, batch_bytes)
    return _counters[key]


def count_tokens(
    docs: DataFrame, model_path: str, limit: int = 4096, *, key: str = "doc_id", text: str = "text", batch_bytes: int = 1 << 20
) -> DataFrame:
    """One row per row of docs: key, n_bytes, n_tokens, over_limit.

    Texts are cut at spaces where no vocabulary entry can reach over the cut;
    segments travel to the library in batches of ``batch_bytes`` and only lengths
    come back. A model with entries across spaces gets whole texts. Null text
    counts as empty (0 bytes, 0 tokens); null and repeated keys stay as they are;
    an empty table gives an empty table; other columns are ignored.
    """
    with open(model_path, "rb") as f:
        model = f.read()
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(model, batch_bytes)
        for b in batches:
            n = counter.count(b.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                names=["k", "n_bytes", "n_tokens", "over_limit"],
            )

    rows = docs.select(
        F.col(key).alias("k"), F.octet_length(text_or_empty(text)).cast("long").alias("n_bytes"), text_or_empty(text).alias("t")
    )
    return rows.mapInArrow(run, f"k {kind}, n_bytes long, n_tokens long, over_limit boolean").withColumnRenamed("k", key)
