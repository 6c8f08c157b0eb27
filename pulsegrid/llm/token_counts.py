"""Token counts of whole texts: batch encoding in an Arrow function that returns lengths only.

Texts are cut at safe boundaries, places where the pre-tokenizer always starts a new word, so the
parts' counts add up to the text's. Distinct parts are encoded by the library in batches balanced
by bytes; a bounded memory of part lengths saves encoding the common ones again.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pick, table

DEFAULT_VOCABULARY = "byte_bpe_50k.json"
#: Token budget of a context, for `over_limit`.
LIMIT = 512
#: UTF-8 bytes of text whose parts are gathered before the new ones are encoded.
BYTES_AT_ONCE = 4 << 20
#: UTF-8 bytes given to the library at once.
BATCH_BYTES = 256 << 10
#: Parts whose lengths a worker remembers.
PARTS_REMEMBERED = 400_000
#: A blank between two characters that no one counts as white space: a word starts at the blank.
SAFE = re.compile(r"(?<=\S)(?= \S)")
UNSAFE = re.compile(r"\s[ ]|[ ]\s|^[ ]|[ ]$")


def size_of(text: str) -> int:
    """UTF-8 bytes."""
    return len(text) if text.isascii() else len(text.encode())


def parts(text: str) -> list[str]:
    """The text cut before every blank that surely starts a word; joined again they are the text."""
    if UNSAFE.search(text):
        return SAFE.split(text)
    first, *rest = text.split(" ")
    return [first, *[f" {x}" for x in rest]]


class Counter:
    """Counts tokens with a vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[str, int] = {}

    def learn(self, new: list[str]) -> None:
        """Encode parts, at most about BATCH_BYTES of them at once, and keep their lengths."""
        batch: list[str] = []
        size = 0
        for x in [*new, None]:
            if x is None or batch and size + size_of(x) > BATCH_BYTES:
                for p, e in zip(batch, self.tokenizer.encode_batch_fast(batch, add_special_tokens=False), strict=True):
                    self.known[p] = len(e)
                batch, size = [], 0
            if x is not None:
                batch.append(x)
                size += size_of(x)

    def count(self, texts: list[str]) -> list[int]:
        cut = [*map(parts, texts)]
        if len(self.known) > PARTS_REMEMBERED:
            self.known.clear()
        self.learn([x for x in set().union(*cut) if x not in self.known])
        get = self.known.__getitem__
        out = [sum(map(get, c)) for c in cut]
        for x in [x for x in self.known if len(x) > 256]:  # long ones are rare and big
            del self.known[x]
        return out


_loaded: dict[str, Counter] = {}


def token_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary_path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row.

    A null text counts as empty (0 bytes, 0 tokens); special strings inside texts count as the
    library's default has them; null ids and repeated rows stay; other columns are not read.
    """
    import public_tokenizers

    path = vocabulary_path or public_tokenizers.path(DEFAULT_VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _loaded:
            _loaded[path] = Counter(path)
        counter = _loaded[path]
        for b in batches:
            counts: list[int] = []
            group: list[str] = []
            size = 0
            for x, n in zip(b.column(1), b.column(2).to_pylist(), strict=True):
                if group and size + n > BYTES_AT_ONCE:
                    counts += counter.count(group)
                    group, size = [], 0
                group.append(x.as_py() or "")
                size += n
            if group:
                counts += counter.count(group)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    docs = pick(df, doc_id=id_col, text=text_col).selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text", "cast(coalesce(octet_length(cast(text as string)), 0) as long) n_bytes")
    return docs.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
