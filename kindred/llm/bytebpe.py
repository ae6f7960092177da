"""Byte-level BPE: encoding and decoding of whole texts with the tokenizers library.

Texts are cut before blanks, where the splitting pattern of byte-level vocabularies always
ends a piece; each distinct part is encoded once and its ids are kept as bytes. Byte-level
vocabularies spell bytes with printable characters; the table of these spellings is
reversed for decoding, where a character may be split over several tokens.
"""

import base64
import json
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, models, pre_tokenizers

from kindred.llm.words import worker_state

# Bytes of parts and ids that a worker keeps, about, and the longest part it keeps, in characters.
KEPT_BYTES = 100_000_000
# What Python takes for a part and its ids beside their characters.
PART_OVERHEAD = 190
KEPT_LENGTH = 64
WORDS_IN_A_ROW = 100

# A simple word before a blank, full stop or comma; else all up to the next blank; blanks at the end.
_PART = re.compile(r"[ \t-\r]*[0-9A-Za-zÀ-ÖØ-öø-ÿ]+(?=[., \t-\r]|\Z)|[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
_LETTER_WORD = re.compile(r" [A-Za-zÀ-ÖØ-öø-ÿ]+")
# Texts with blanks beyond ASCII are encoded in one piece: these join with the blanks next to them.
_WIDE_BLANK = re.compile("[\x85\xa0  -     　]")


def byte_characters():
    """The character that spells each byte: itself if visible, else one from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


def read_ranks(path):
    """`{bytes: rank}` of a rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def tokenizer_from_ranks(ranks, pattern):
    """JSON of a tokenizer that merges as the ranks do, within each match of `pattern`.

    Under ranks, two neighbours join whenever their joint bytes have a rank, the lowest
    rank first. So every pair of known tokens that makes a known token is a merge, in the
    order of what it makes; a match that is a token itself is taken as it is.
    """
    spell = byte_characters()
    written = {token: "".join(spell[b] for b in token) for token in ranks}
    merges = []
    for token in sorted(ranks, key=ranks.get):
        for cut in range(1, len(token)):
            if token[:cut] in ranks and token[cut:] in ranks:
                merges.append((written[token[:cut]], written[token[cut:]]))
    vocabulary = {written[token]: rank for token, rank in ranks.items()}
    tokenizer = Tokenizer(models.BPE(vocab=vocabulary, merges=merges, ignore_merges=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
    )
    return tokenizer.to_str()


def read_tokenizer(path):
    """JSON of a tokenizer file."""
    with open(path, encoding="utf-8") as text:
        return text.read()


def token_bytes(tokenizer_json):
    """The bytes of each id, by reversing the spelling; added tokens stand for their text."""
    content = json.loads(tokenizer_json)
    byte_of = {c: b for b, c in enumerate(byte_characters())}
    table = {i: bytes(byte_of[c] for c in token) for token, i in content["model"]["vocab"].items()}
    table |= {added["id"]: added["content"].encode() for added in content.get("added_tokens", [])}
    return [table.get(i, b"") for i in range(max(table) + 1)]


class PartEncoder:
    """Ids of texts, as little-endian unsigned 32-bit numbers in bytes."""

    def __init__(self, tokenizer_json):
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.kept, self.held = {}, 0
        self.table = token_bytes(tokenizer_json)
        # Ids of tokens that begin with a blank: no other token of a letter word does.
        begins = [i for i, token in enumerate(self.table) if token[:1] == b" "]
        self.begins = np.zeros(self.tokenizer.get_vocab_size() + 1, dtype=bool)
        self.begins[begins] = True

    def _ids(self, texts):
        for found in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
            yield np.array(found.ids, dtype="<u4")

    def _learn(self, parts):
        """`(part, ids)` of each of `parts`, which are encoded on their own.

        Words of letters with a blank before them are pieces of the splitting pattern
        wherever they stand, so many are encoded in a row and told apart by their blanks.
        """
        words, others = [], []
        for part in parts:
            (words if _LETTER_WORD.fullmatch(part) else others).append(part)
        rows = [words[i : i + WORDS_IN_A_ROW] for i in range(0, len(words), WORDS_IN_A_ROW)]
        for row, ids in zip(rows, self._ids(["".join(row) for row in rows])):
            data, starts = ids.tobytes(), (np.flatnonzero(self.begins[ids]) * 4).tolist()
            if len(starts) == len(row):
                yield from ((part, data[a:b]) for part, a, b in zip(row, starts, [*starts[1:], len(data)]))
            else:  # a vocabulary that ends tokens elsewhere
                others += row
        yield from ((part, ids.tobytes()) for part, ids in zip(others, self._ids(others)))

    def __call__(self, texts):
        """Ids of each text; None is taken as empty."""
        parts = [_PART.findall(t) if t and (t.isascii() or not _WIDE_BLANK.search(t)) else None for t in texts]
        if self.held > KEPT_BYTES:
            self.kept, self.held = {}, 0
        long = {}
        for part, ids in self._learn(set(chain.from_iterable(p for p in parts if p)).difference(self.kept)):
            (self.kept if len(part) <= KEPT_LENGTH else long)[part] = ids
            self.held += len(part) + len(ids) + PART_OVERHEAD
        get = self.kept.__getitem__
        for text, found in zip(texts, parts):
            if found is None:
                yield next(self._ids([text])).tobytes() if text else b""
            elif long and not long.keys().isdisjoint(found):
                yield b"".join([long[p] if p in long else get(p) for p in found])
            else:
                yield b"".join(map(get, found))


def part_encoder(tokenizer_json):
    """The encoder of this worker process: what it has learned serves its later tasks."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task for each core
    return worker_state(tokenizer_json, lambda: PartEncoder(tokenizer_json))


def in_slices(texts, most_characters=1_000_000):
    """Stretches of a list of texts with about so many characters in all, one text at least."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text or "")
        if held >= most_characters:
            yield texts[start : i + 1]
            start, held = i + 1, 0
    if start < len(texts):
        yield texts[start:]


def encode(docs, tokenizer_json):
    """`(doc_id, ids)` for every row: the ids of its whole text as little-endian unsigned 32-bit numbers.

    A null text counts as empty and has no ids. Repeated rows are each encoded; other
    columns are not read; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)

    def work(batches):
        encoder = part_encoder(shared.value)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            ids = [row for part in in_slices(texts) for row in encoder(part)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    rows = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"))
    return rows.mapInArrow(work, "doc_id bigint, ids binary")


def decode_ids(ids, table):
    """Bytes of ids given as bytes; an id without an entry raises."""
    return b"".join(map(table.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def decode(encoded, tokenizer_json):
    """`(doc_id, decoded)` for rows `(doc_id, ids)`: the bytes that the ids stand for; null ids give null.

    Tokens may hold parts of a character, so texts are put together as bytes;
    `decoded.cast('string')` of whole documents is the text again.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(token_bytes(tokenizer_json))

    def work(batches):
        worker_state()
        table = shared.value
        for batch in batches:
            found = [None if ids is None else decode_ids(ids, table) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.binary())], ["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(work, "doc_id bigint, decoded binary")


def spans(ids, table):
    """Character spans `(starts, ends)` of ids; a token that holds part of a character spans all of it."""
    tokens = np.frombuffer(ids, dtype="<u4")
    sizes = np.array([len(t) for t in table], dtype=np.int64)[tokens]
    ends = np.cumsum(sizes)
    data = np.frombuffer(decode_ids(ids, table), dtype=np.uint8)
    character = np.cumsum((data & 0xC0) != 0x80) - 1
    starts = ends - sizes
    return character[starts], character[ends - 1] + 1


def encode_with_spans(docs, tokenizer_json):
    """`(doc_id, ids, starts, ends)` for every row, ids and character spans as arrays; empty for a null or empty text."""
    shared = docs.sparkSession.sparkContext.broadcast((tokenizer_json, token_bytes(tokenizer_json)))

    def work(batches):
        encoder, table = part_encoder(shared.value[0]), shared.value[1]
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder(batch.column("text").to_pylist())):
                starts, ends = spans(ids, table)
                rows.append((doc_id, np.frombuffer(ids, dtype="<u4").astype(np.int32), starts.astype(np.int32), ends.astype(np.int32)))
            columns = [pa.array([r[0] for r in rows], pa.int64())]
            columns += [pa.array([r[i] for r in rows], pa.list_(pa.int32())) for i in (1, 2, 3)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "starts", "ends"])

    rows = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"))
    return rows.mapInArrow(work, "doc_id bigint, ids array<int>, starts array<int>, ends array<int>")


def round_trip(docs, tokenizer_json):
    """`(doc_id, ids, decoded)` for every row: encoded, and the ids decoded again, in one step.

    Nulls, repeated rows and other columns as in `encode`; a text without ids decodes to nothing.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)

    def work(batches):
        encoder = part_encoder(shared.value)
        for batch in batches:
            ids, row = batch.column("doc_id"), 0
            for texts in in_slices(batch.column("text").to_pylist()):
                found = list(encoder(texts))
                columns = [ids.slice(row, len(found)), pa.array(found, pa.binary())]
                columns.append(pa.array([decode_ids(i, encoder.table) for i in found], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"])
                row += len(found)

    rows = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"))
    return rows.mapInArrow(work, "doc_id bigint, ids binary, decoded binary")


def digests(trips):
    """`(doc_id, n_tokens, ids_sha256, decoded_sha256)` of rows of `round_trip`."""
    return trips.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
