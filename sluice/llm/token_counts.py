"""Token counts of whole texts under a given byte-level BPE vocabulary.

Texts go through the tokenizer library in Arrow functions that return lengths
only.  Every text is split at safe boundaries, places where the tokenizer's own
splitting rule always splits, so the pieces' token counts add up to the text's:

* before a space, tab or line end that follows anything but white space;
* in a piece of over ``LONG_PIECE`` characters also between an ASCII letter and
  an ASCII digit.

Texts with rarer white space, for which the first rule is not safe, are encoded
whole.  Equal pieces of a batch are encoded once, in calls of about
``CALL_BYTES``, so a call's memory follows neither the batch nor its longest
text; the counts of the first ``REMEMBERED`` pieces are kept for the task.
A vocabulary file with another splitting rule than byte-level BPE's, or with
added tokens that hold a boundary, has no safe boundary here: its texts are
encoded whole.

The file is read by the driver (a few MB) and broadcast, so executors need the
library but not the file.

Defined results: a null text counts as empty, with 0 bytes and tokens; null and
repeated ids and repeated rows each give a row of their own; strings of special
tokens inside texts count as the library's default has it, one token each; an
empty table gives an empty result; extra input columns are ignored; no text is
cut short, however long.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import bound_batches, plain_names, table
from sluice.llm.words import buffers, row_slices

#: A piece: white space of the plain kinds, then all up to the next of it; white space may end a text.
PIECES = re.compile(r"[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+")
#: White space of other kinds.
RARE_SPACE = re.compile(r"[^\S \t\n\r]")
LETTER_DIGIT = re.compile(r"(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")
#: Text bytes split at once, bytes handed to the library at once, and characters from which a piece is long.
SLICE_BYTES, CALL_BYTES, LONG_PIECE = 2 << 20, 256 << 10, 16 << 10
#: Pieces whose counts a task remembers.
REMEMBERED = 400_000


def splits_safely(definition: dict) -> bool:
    """Whether the boundaries above hold for this tokenizer file."""
    pre = definition.get("pre_tokenizer") or {}
    plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space", True)
    added = definition.get("added_tokens") or []
    whole = all(
        not (t.get("lstrip") or t.get("rstrip") or t.get("single_word") or re.search(r"\s", t["content"]) or LETTER_DIGIT.search(t["content"]))
        for t in added
    )
    return plain and whole and not definition.get("normalizer")


def pieces(text: str) -> list[str]:
    """``text`` split at safe boundaries."""
    if RARE_SPACE.search(text):
        return [text]
    found = PIECES.findall(text)
    if len(text) > LONG_PIECE and max(map(len, found)) > LONG_PIECE:
        found = [x for p in found for x in (LETTER_DIGIT.split(p) if len(p) > LONG_PIECE else [p])]
    return found


def calls(texts: Iterable[str], size: int) -> Iterable[list[str]]:
    """``texts`` in groups of about ``size`` characters; a longer one is a group of its own."""
    group, held = [], 0
    for text in texts:
        if group and held + len(text) > size:
            yield group
            group, held = [], 0
        group.append(text)
        held += len(text)
    if group:
        yield group


class Lengths:
    """Token counts of pieces, each distinct piece encoded once."""

    def __init__(self, encode: Callable[[list[str]], list[int]]) -> None:
        self.encode, self.known = encode, {}

    def __call__(self, found: list[str]) -> np.ndarray:
        known = self.known
        fresh = {p: 0 for p in found if p not in known}
        for group in calls(sorted(fresh, key=len), CALL_BYTES):
            fresh.update(zip(group, self.encode(group)))
        if len(known) + len(fresh) <= REMEMBERED:
            known.update(fresh)
            lengths = map(known.__getitem__, found)
        else:
            lengths = (fresh[p] if p in fresh else known[p] for p in found)
        return np.fromiter(lengths, np.int64, len(found))


def _encoder(definition: str) -> Callable[[list[str]], list[int]]:
    # a task has one core; threads of its own would take others'
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(definition)
    tokenizer.no_truncation()
    tokenizer.no_padding()

    def encode(texts: list[str]) -> list[int]:
        return [len(x) for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    return encode


def batch_lengths(column: pa.Array, lengths: Lengths, split: Callable[[str], list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and tokens of each text of a batch, in ranges of rows of about ``SLICE_BYTES``."""
    offsets, data = buffers(column)
    tokens = np.zeros(len(column), np.int64)
    for lo, hi in row_slices(offsets, SLICE_BYTES):
        parts = [split(str(data[offsets[i] : offsets[i + 1]], "utf-8")) if offsets[i + 1] > offsets[i] else [] for i in range(lo, hi)]
        n = lengths([p for x in parts for p in x])
        ends = np.cumsum([len(x) for x in parts])
        upto = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], ends])]
        tokens[lo:hi] = np.diff(upto)
    return np.diff(offsets), tokens


def _counts(shared, safe: bool):
    def run(batches):
        lengths = None
        for batch in batches:
            lengths = lengths or Lengths(_encoder(shared.value))
            n_bytes, n_tokens = batch_lengths(batch.column("text"), lengths, pieces if safe else lambda text: [text])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_bytes), pa.array(n_tokens)], names=["doc_id", "n_bytes", "n_tokens"]
            )

    return run


def token_counts(
    docs: DataFrame, vocabulary: str, limit: int = 1024, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens).

    ``vocabulary`` is the path, on the driver, of a tokenizer file in JSON.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    with open(vocabulary, encoding="utf-8") as f:
        definition = f.read()
    shared = spark.sparkContext.broadcast(definition)
    d = plain_names(docs, doc_id=doc_id, text=text)
    kind = docs.schema[doc_id].dataType.simpleString()
    counted = d.mapInArrow(_counts(shared, splits_safely(json.loads(definition))), f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op13_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))
