"""Fill-in-the-middle by piece tables.

A document is a list of descriptors (buffer, start, size) over two buffers that never change: its UTF-8 text and the sentinels. Cutting
splits a descriptor, an arrangement permutes descriptors and puts sentinel descriptors between them, and the inverse permutation restores
the text; hashes and outputs stream the descriptors.

Units are runs of A-Z and a-z, or one other code point. The cuts and the form come from sha256 of `1:` and the decimal doc_id, as four
numbers h1 to h4 of eight hex digits: prefix and middle end after the smaller and the larger of h1 and h2 modulo (units + 1); `plain` if
the text is empty, holds a sentinel or h3 % 100 >= PLAIN_FROM; else `spm` if h4 % 100 < SPM_BELOW, else `psm`.

    psm: <P>prefix<S>suffix<M>middle        spm: <S>suffix<P>prefix<M>middle

Every step is one pass over the rows without a shuffle; text is read in windows, so a very long text costs its own bytes and no more.

Defined results: null text is empty and plain; the decimal of a null doc_id is empty; rows are treated one by one, so repeated rows and
ties give equal rows; texts without any letter have a unit per code point; an empty table gives no rows; other columns are ignored, and
pass through `fill_in_middle` untouched unless they have the name of one of its outputs, which is an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The sentinels, in the order in which they stand in their buffer.
SENTINELS = b"<P><S><M>"
PLAIN_FROM, SPM_BELOW = 90, 20
WINDOW = 1 << 20

TEXT, MARKS = 0, 1
P, S, M = ((MARKS, at, 3) for at in (0, 3, 6))
#: For each form its sentinels, and which part (0 prefix, 1 middle, 2 suffix) follows each of them.
FORMS = {"psm": ((P, S, M), (0, 2, 1)), "spm": ((S, P, M), (2, 0, 1))}

Piece = tuple[int, int, int]


class PieceTable:
    """Descriptors over a text and the sentinels."""

    def __init__(self, text: bytes, pieces: list[Piece] | None = None) -> None:
        self.buffers = (memoryview(text), memoryview(SENTINELS))
        self.pieces = [(TEXT, 0, len(text))] if pieces is None else pieces

    def cut(self, at: int) -> None:
        """Split the descriptor that holds text offset `at`, so that a piece begins there; at an end it leaves an empty piece."""
        for i, (buffer, start, size) in enumerate(self.pieces):
            if buffer == TEXT and start <= at <= start + size:
                self.pieces[i:i + 1] = [(TEXT, start, at - start), (TEXT, at, start + size - at)]
                return
        raise ValueError(f"no piece holds offset {at}")

    def arrange(self, form: str) -> None:
        marks, order = FORMS[form]
        self.pieces = [piece for mark, part in zip(marks, order, strict=True) for piece in (mark, self.pieces[part])]

    def restore(self, form: str) -> None:
        """The inverse permutation: drop the sentinel descriptors and put the parts back in their places."""
        parts = [piece for piece in self.pieces if piece[0] == TEXT]
        self.pieces = [parts[i] for i in np.argsort(FORMS[form][1])]

    def stream(self) -> Iterator[memoryview]:
        for buffer, start, size in self.pieces:
            for at in range(start, start + size, WINDOW):
                yield self.buffers[buffer][at:min(at + WINDOW, start + size)]

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for part in self.stream():
            digest.update(part)
        return digest.hexdigest()

    def content(self) -> bytes:
        return b"".join(self.stream())

    @classmethod
    def of_output(cls, output: bytes, form: str) -> PieceTable:
        """The descriptors of an arranged output, found by its sentinels."""
        if form == "plain":
            return cls(output)
        pieces: list[Piece] = []
        at = 0
        for mark in FORMS[form][0]:
            found = output.index(SENTINELS[mark[1]:mark[1] + 3], at)
            if pieces:
                pieces[-1] = (TEXT, at, found - at)
            elif found:
                raise ValueError("text before the first sentinel")
            at = found + 3
            pieces += [mark, (TEXT, at, len(output) - at)]
        return cls(output, pieces)


def _starts(data: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """For each window its offset and where units begin in it."""
    before = False
    for at in range(0, len(data), WINDOW):
        part = np.frombuffer(data, np.uint8, min(WINDOW, len(data) - at), at)
        letter = ((part | 32) - np.uint8(97)) < 26
        inside = letter & np.r_[before, letter[:-1]]
        yield at, ~inside & ((part & 0xC0) != 0x80)
        before = bool(letter[-1])


def n_units(data: bytes) -> int:
    return sum(int(np.count_nonzero(begins)) for _, begins in _starts(data))


def unit_offset(data: bytes, units: int) -> int:
    """The byte offset after so many units."""
    for at, begins in _starts(data):
        here = int(np.count_nonzero(begins))
        if units < here:
            return at + int(np.flatnonzero(begins)[units])
        units -= here
    return len(data)


def n_chars(data: bytes, start: int, size: int) -> int:
    return sum(int(np.count_nonzero((np.frombuffer(data, np.uint8, min(WINDOW, start + size - at), at) & 0xC0) != 0x80))
               for at in range(start, start + size, WINDOW))


def draws(key: str) -> list[int]:
    digest = hashlib.sha256(f"1:{key}".encode()).hexdigest()
    return [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]


def build(key: str, text: bytes) -> tuple[PieceTable, str, int]:
    """(arranged table, form, units) of one document; `key` is its decimal doc_id."""
    h1, h2, h3, h4 = draws(key)
    table, n = PieceTable(text), n_units(text)
    if not text or h3 % 100 >= PLAIN_FROM or any(SENTINELS[i:i + 3] in text for i in (0, 3, 6)):
        return table, "plain", n
    first, last = sorted((h1 % (n + 1), h2 % (n + 1)))
    for units in (first, last):
        table.cut(unit_offset(text, units))
    form = "spm" if h4 % 100 < SPM_BELOW else "psm"
    table.arrange(form)
    return table, form, n


def parts(table: PieceTable, form: str) -> list[Piece]:
    """Descriptors of prefix, middle and suffix."""
    kept = [p for p in table.pieces if p[0] == TEXT]
    return [kept[i] for i in np.argsort(FORMS[form][1])]


def _built(keys: Iterable[str], texts: Iterable[bytes]) -> Iterator[tuple[bytes, PieceTable, str, int]]:
    for key, text in zip(keys, texts, strict=True):
        yield text, *build(key, text)


def _input(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), *_key_and_text(text, doc_id))


def _key_and_text(text: str, doc_id: str) -> tuple[Column, Column]:
    whole = F.coalesce(F.col(text), F.lit("")).cast("binary")
    return F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("key"), whole.alias("text")


def _of(batch: pa.RecordBatch) -> Iterator[tuple[bytes, PieceTable, str, int]]:
    return _built(batch.column(1).to_pylist(), (t.as_py() for t in batch.column(2)))


def _kind(docs: DataFrame, column: str) -> str:
    return docs.schema[column].dataType.simpleString()


def piece_tables(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n (units), form, pieces (the arranged descriptors; buffer 0 is the text, 1 the sentinels)."""

    def run(batches):
        for batch in batches:
            out = [(n, form, [dict(zip(("buffer", "start", "size"), p, strict=True)) for p in table.pieces]) for _, table, form, n in _of(batch)]
            columns = list(zip(*out, strict=True)) or [()] * 3
            piece = pa.struct([("buffer", pa.int32()), ("start", pa.int64()), ("size", pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.list_(piece))],
                names=["doc_id", "n", "form", "pieces"])

    return _input(docs, text, doc_id).mapInArrow(
        run, f"doc_id {_kind(docs, doc_id)}, n long, form string, pieces array<struct<buffer:int,start:long,size:long>>")


def fill_in_middle(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents with two more columns: fim_form and fim_text, the arranged text."""
    taken = {"fim_form", "fim_text"} & set(docs.columns)
    if taken:
        raise ValueError(f"columns {sorted(taken)} are there already")

    @F.pandas_udf("struct<form:string,output:binary>")
    def run(keys: pd.Series, texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([(form, table.content()) for _, table, form, _ in _built(keys, texts)], columns=["form", "output"])

    made = docs.select(*docs.columns, run(*_key_and_text(text, doc_id)).alias("fim_form"))
    return made.select(*docs.columns, F.col("fim_form.form").alias("fim_form"), F.col("fim_form.output").cast("string").alias("fim_text"))


def restored(outputs: DataFrame, output: str = "fim_text", form: str = "fim_form", out: str = "restored") -> DataFrame:
    """The rows with the text rebuilt from output and form alone."""

    @F.pandas_udf("binary")
    def run(outputs: pd.Series, forms: pd.Series) -> pd.Series:
        return pd.Series([_restored(t, form).content() for t, form in zip(outputs, forms, strict=True)], dtype=object)

    return outputs.withColumn(out, run(F.col(output).cast("binary"), F.col(form)).cast("string"))


def _restored(output: bytes, form: str) -> PieceTable:
    table = PieceTable.of_output(output, form)
    if form != "plain":
        table.restore(form)
    return table


def digest(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256 and restored_sha256: the text rebuilt from the written output and its form."""

    def run(batches):
        for batch in batches:
            out = []
            for text, table, form, n in _of(batch):
                sizes = [None, None] if form == "plain" else [n_chars(text, start, size) for _, start, size in parts(table, form)[:2]]
                out.append((n, form, *sizes, table.sha256(), _restored(table.content(), form).sha256()))
            columns = list(zip(*out, strict=True)) or [()] * 6
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                                             names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"])

    return _input(docs, text, doc_id).mapInArrow(
        run, f"doc_id {_kind(docs, doc_id)}, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string")
