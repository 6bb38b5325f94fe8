"""Whole-corpus encoding with a public tokenizer, as a monoid tree reduction.

Every text is cut into halves until the leaves are small, the leaves are encoded, and neighbours are
joined going up. Only a window around each seam is encoded again. The window grows to both sides until
it ends at places where the pre-token pattern must start a new token whatever stands further away, so
the tokens outside of it are proven to stay. Very long texts are first spread over rows, and their pieces
are joined pairwise in Spark with the same join.

The defined cases: a null or empty text has no ids (an empty list); strings of special tokens in a text are
ordinary text; every row of the input gives one row (repeated keys stay repeated); other columns are
ignored whatever their names.
"""

from __future__ import annotations

import base64
import importlib.util
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters of a text that one leaf of the tree holds.
LEAF_CHARS = 4096
#: Characters of a text that one row holds; longer texts are spread over rows.
ROW_CHARS = 1 << 20
#: First width of the window around a seam; it doubles as often as needed.
WINDOW_CHARS = 64

# The pre-token pattern that belongs to the byte-level vocabulary files.
PRETOKEN_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Places where the pattern starts a token whatever the rest is: white space after another character,
#: and the end of a run of letters or of digits.
_FIRM = regex.compile(r"(?<=\S)(?=\s)|(?<=\p{L})(?=[^\s\p{L}])|(?<=\p{N})(?=[^\s\p{N}])")


def default_tokenizer_dir() -> str:
    """The folder of the public vocabulary files: FRESHET_TOKENIZERS, /opt/tokenizers or the installed package."""
    if d := os.environ.get("FRESHET_TOKENIZERS"):
        return d
    if os.path.isdir("/opt/tokenizers"):
        return "/opt/tokenizers"
    spec = importlib.util.find_spec("public_tokenizers")
    return os.path.dirname(spec.origin) if spec and spec.origin else "/opt/tokenizers"


class Encoder:
    """One vocabulary in a Python worker: leaves, seams and decoding."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self._enc = tiktoken.Encoding(path, pat_str=PRETOKEN_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._bytes = {rank: token for token, rank in ranks.items()}

    def leaf(self, text: str) -> list[int]:
        return self._enc.encode_ordinary(text)

    def _head(self, ids: list[int], n_bytes: int) -> int:
        """How many tokens cover the first n_bytes."""
        k = 0
        while n_bytes > 0:
            n_bytes -= len(self._bytes[ids[k]])
            k += 1
        return k

    def _tail(self, ids: list[int], n_bytes: int) -> int:
        k = 0
        while n_bytes > 0:
            k += 1
            n_bytes -= len(self._bytes[ids[-k]])
        return k

    def join(self, left: str, left_ids: list[int], right: str, right_ids: list[int]) -> list[int]:
        """The ids of left + right, given those of each."""
        if not left or not right:
            return left_ids or right_ids
        w, start = WINDOW_CHARS, None
        while start is None:
            at = [m.start() for m in _FIRM.finditer(left[-w:])]
            start = len(left) - min(w, len(left)) + at[-1] if at else (0 if w >= len(left) else None)
            w *= 2
        w, end = WINDOW_CHARS, None
        while end is None:
            m = _FIRM.search(right[:w])
            end = m.start() if m else (len(right) if w >= len(right) else None)
            w *= 2
        drop = self._tail(left_ids, len(left[start:].encode()))
        skip = self._head(right_ids, len(right[:end].encode()))
        return left_ids[: len(left_ids) - drop] + self.leaf(left[start:] + right[:end]) + right_ids[skip:]

    def tree(self, text: str, leaf_chars: int) -> list[int]:
        if len(text) <= leaf_chars:
            return self.leaf(text)
        half = len(text) // 2
        left, right = text[:half], text[half:]
        return self.join(left, self.tree(left, leaf_chars), right, self.tree(right, leaf_chars))

    def decode(self, ids: list[int]) -> str:
        return b"".join(self._bytes[i] for i in ids).decode("utf-8", "replace")


_LOADED: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file, or for the name of one that was sent to the executors; loaded once a process."""
    if path not in _LOADED:
        _LOADED[path] = Encoder(path if os.path.isabs(path) else SparkFiles.get(path))
    return _LOADED[path]


def _vocabulary(spark: SparkSession, name: str, tokenizer_dir: str | None) -> str:
    """Sends the vocabulary file to the executors; gives the name it has there."""
    spark.sparkContext.addFile(os.path.join(tokenizer_dir or default_tokenizer_dir(), f"{name}.tiktoken"))
    return f"{name}.tiktoken"


def _texts(path: str, leaf_chars: int, count: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """mapInArrow function: the last column is the text; it is replaced by its ids or their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids = [enc.tree(t, leaf_chars) if t else [] for t in part.column(part.num_columns - 1).to_pylist()]
                new = pa.array(map(len, ids), pa.int64()) if count else pa.array(ids, pa.list_(pa.int32()))
                kept = part.columns[:-1]
                yield pa.RecordBatch.from_arrays([*kept, new], [*part.schema.names[:-1], "n" if count else "ids"])

    return run


def _join_pairs(path: str) -> Callable:
    """applyInPandas function over one pair of neighbouring pieces of one row."""

    def run(key, pdf):
        enc = encoder(path)
        pdf = pdf.sort_values("piece")
        out = pdf.iloc[:1].copy()
        if len(pdf) == 2:
            (a, b), (x, y) = pdf["text"], pdf["ids"]
            out["ids"] = [enc.join(a, [int(i) for i in x], b, [int(i) for i in y])]
            out["text"] = [a + b]
        out["piece"] = out["piece"] // 2
        return out

    return run


def encode_corpus(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    vocabulary: str = "byte_bpe_50k",
    tokenizer_dir: str | None = None,
    leaf_chars: int = LEAF_CHARS,
    row_chars: int = ROW_CHARS,
    count_only: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """(key, *keep, ids) of every row, or (key, *keep, n) with the number of ids if count_only.

    No shuffle takes place but for texts over row_chars characters: these are spread over rows, encoded
    in pieces and joined pairwise, in as many rounds as the longest text needs.
    """
    path = _vocabulary(docs.sparkSession, vocabulary, tokenizer_dir)
    src = docs.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_keep{i}") for i, c in enumerate(keep)], F.col(text).alias("_text"))
    ks = src.columns[:-1]
    value = "n bigint" if count_only else "ids array<int>"
    head = ", ".join(f"{c} {t}" for c, t in src.dtypes[:-1])
    one = src.filter(F.col("_text").isNull() | (F.char_length("_text") <= row_chars))
    out = one.mapInArrow(_texts(path, leaf_chars, count_only), f"{head}, {value}")

    # The number of rounds depends on the longest text only; the length is one number.
    longest = docs.agg(F.max(F.char_length(F.col(text)))).first()[0] or 0
    if longest > row_chars:
        pieces = F.ceil(F.char_length("_text") / row_chars)
        many = (
            src.filter(F.char_length("_text") > row_chars)
            .withColumn("row", F.expr("uuid()"))
            .withColumn("piece", F.explode(F.sequence(F.lit(0), (pieces - 1).cast("int"))))
            .withColumn("text", F.expr(f"substring(_text, piece * {row_chars} + 1, {row_chars})"))
            .drop("_text")
            .repartition("row", "piece")
        )
        shape = f"{head}, row string, piece int, text string"
        enc = many.select(*ks, "row", "piece", "text", F.col("text").alias("_text")).mapInArrow(_texts(path, leaf_chars, False), f"{shape}, ids array<int>")
        from freshet.session import cut

        enc = cut(enc)  # uuid() and the leaves must not be made again
        n = -(-longest // row_chars)
        while n > 1:
            enc = enc.groupBy("row", F.floor(F.col("piece") / 2)).applyInPandas(_join_pairs(path), f"{shape}, ids array<int>")
            n = -(-n // 2)
        out = out.unionByName(enc.select(*ks, (F.size("ids").cast("bigint").alias("n") if count_only else F.col("ids"))))
    return out.select(F.col("_key").alias(key), *[F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep)], "n" if count_only else "ids")


def decode_corpus(encoded: DataFrame, key: str = "doc_id", ids: str = "ids", vocabulary: str = "byte_bpe_50k", tokenizer_dir: str | None = None) -> DataFrame:
    """(key, text): the bytes of the ids in order. Null ids give a null text, no ids an empty one."""
    path = _vocabulary(encoded.sparkSession, vocabulary, tokenizer_dir)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            texts = [None if x is None else enc.decode(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["_key", "text"])

    src = encoded.select(F.col(key).alias("_key"), F.col(ids).alias("_ids"))
    return src.mapInArrow(run, f"_key {src.dtypes[0][1]}, text string").withColumnRenamed("_key", key)
