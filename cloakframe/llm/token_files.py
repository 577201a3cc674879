"""Token ids in seekable binary files: one independent zstandard frame per document.

A file is a run of zstandard frames, each holding one document's ids as little-endian unsigned 32-bit integers, then
two skippable frames: the ids of the documents, and the seek table of the public seekable format (compressed size,
plain size and a checksum, the low half of XXH64, for each frame). A reader takes the footer, finds the frames of the
documents it wants and decompresses only those.

Files follow each other in ascending order of the document id: a range partition each, sorted.

Words between ASCII white space are encoded one by one and remembered where the tokenizer never joins anything across
white space, nor a letter or digit with the punctuation behind it; a test holds the result against the encoding of
whole texts. That is so for tokenizers whose definition has the parts in ``WORDWISE``. With any other definition, texts
are encoded whole.

Results in odd cases: a null or empty text has the end id only; null ids come first; rows with equal ids each get
their frame, in an order that a hash of the text and the text decide; an empty table gives no file and no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cloakframe.llm.files import file_system, kept, read_parts, with_base, write_parts

# Fixed values of the seekable format.
SKIPPABLE, SEEK_TABLE, SEEKABLE, CHECKSUMS = 0x184D2A5D, 0x184D2A5E, 0x8F92EAB1, 0x80
ENTRY, FOOTER = "<III", "<IBI"
ENTRY_SIZE, FOOTER_SIZE = struct.calcsize(ENTRY), struct.calcsize(FOOTER)
END_ID = 1
# Words, and words without punctuation, that a worker remembers at most before those not met again go; twice as many in all.
REMEMBERED, REMEMBERED_STEMS = 500_000, 400_000
MARKS = b".,;:!?"


# The parts of a definition for which words can be encoded apart.
WORDWISE = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "post_processor": None,
    "truncation": None,
}


def is_wordwise(definition: str) -> bool:
    """Whether a tokenizer has the parts that encoding word by word relies on: those named, a model of byte pairs without
    chance, and only special tokens beside it, which start with ``<`` and hold no white space."""
    parts = json.loads(definition)
    added = parts.get("added_tokens") or []
    plain = all(
        t["content"].startswith("<") and not t["content"].split()[1:] and not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"])
        for t in added
    )
    model = parts["model"]
    return plain and model.get("type") == "BPE" and not model.get("dropout") and all(parts.get(k) == v for k, v in WORDWISE.items())


def byte_signs() -> dict[int, str]:
    """The sign that stands for each byte in a byte-level vocabulary: itself if it is printable in Latin-1, else the
    next one from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {b: chr(b if b in printable else next(rest)) for b in range(256)}
AT_ONCE = 500  # documents whose words are looked up together


class Encoder:
    """Ids of texts as bytes. ``definition`` is the tokenizer's JSON."""

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.model, self.signs = self.tokenizer.model, byte_signs()
        self.wordwise = is_wordwise(definition)
        self.ids: dict[bytes, bytes] = {}
        self.stems: dict[str, bytes] = {}
        self.older_ids, self.older_stems = {}, {}

    @staticmethod
    def parts(word: bytes) -> tuple[str, str]:
        """A word as a stem and the punctuation behind it, which the tokenizer encodes apart where the stem ends with a
        letter or digit that stays one. Stems of such characters go by their lower case, as they are encoded. These are
        the letters and digits below U+0180 but for U+0130: others may turn into a letter and a mark, which joins the
        punctuation."""
        if word.isalpha():  # ASCII letters
            return word.decode().lower(), ""
        stem = word.rstrip(MARKS)
        text, behind = stem.decode(), word[len(stem) :].decode()
        last = text[-1:]
        if behind and not (last.isalnum() and last < "\u0180" and last != "\u0130"):
            text, behind = text + behind, ""
        if "<" not in text and max(text, default="") < "\u0180" and "\u0130" not in text:
            text = text.lower()
        return text, behind

    def _learn(self, words: set[bytes]) -> None:
        letters = {w: w.lower().decode() for w in words if w.isalpha()}  # ASCII letters, most of the words
        cut = {w: self.parts(w) for w in words.difference(letters)}
        needed = {*letters.values(), *chain.from_iterable(cut.values())} - {""}
        new = needed.difference(self.stems)
        if len(new) + len(self.stems) > REMEMBERED_STEMS:
            self.stems, self.older_stems = {}, self.stems
            new = needed
        again = {p: self.older_stems[p] for p in new if p in self.older_stems}
        self.stems.update(again)
        new = new.difference(again)
        # Lower-case letters below U+0180 are one word to the tokenizer and stay as they are, so its model is asked
        # directly; for everything else it runs as a whole.
        plain = {p for p in new if p.isalpha() and (p.isascii() or max(p) < "\u0180" and "\u0130" not in p)}
        tokenize, signs, known = self.model.tokenize, self.signs, self.stems
        for p in plain:
            found = tokenize(p if p.isascii() else p.encode().decode("latin-1").translate(signs))
            known[p] = array("I", [t.id for t in found]).tobytes()
        listed = list(new - plain)
        encoded = self.tokenizer.encode_batch_fast(listed, add_special_tokens=False)
        known.update((p, array("I", e.ids).tobytes()) for p, e in zip(listed, encoded, strict=True))
        self.ids.update(zip(letters, map(known.__getitem__, letters.values()), strict=True))
        self.ids.update((w, known[a] + known[b] if b else known[a]) for w, (a, b) in cut.items())

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.wordwise:
            return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        split = [t.encode().split() for t in texts]
        new = set(chain.from_iterable(split)).difference(self.ids)
        if len(new) + len(self.ids) > REMEMBERED:
            self.ids, self.older_ids = {}, self.ids
            new = set(chain.from_iterable(split))
        again = {w: self.older_ids[w] for w in new if w in self.older_ids}
        self.ids.update(again)
        self._learn(new.difference(again))
        return [b"".join(map(self.ids.__getitem__, words)) for words in split]


def _encoder(definition: str) -> Encoder:
    held = kept()
    key = xxhash.xxh64_hexdigest(definition)
    if key not in held:
        held[key] = Encoder(definition)
    return held[key]


def write_frames(stream, documents: Iterator[tuple[int | None, bytes]]) -> tuple[int, int]:
    """Writes one file; returns the numbers of documents and of ids."""
    compressor = zstandard.ZstdCompressor(level=3, write_checksum=True)
    table, names, nulls, units = [], array("q"), 0, 0
    for name, data in documents:
        frame = compressor.compress(data)
        stream.write(frame)
        table.append(struct.pack(ENTRY, len(frame), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        units += len(data) // 4
        if name is None:
            nulls += 1
        else:
            names.append(name)
    listed = struct.pack("<I", nulls) + names.tobytes()
    stream.write(struct.pack("<II", SKIPPABLE, len(listed)) + listed)
    entries = b"".join(table)
    stream.write(struct.pack("<II", SEEK_TABLE, len(entries) + FOOTER_SIZE) + entries)
    stream.write(struct.pack(FOOTER, len(table), CHECKSUMS, SEEKABLE))
    return len(table), units


def read_index(file) -> tuple[np.ndarray, int, np.ndarray]:
    """(document ids, number of leading documents without an id, entries) of an open file."""
    size = file.size()
    count, flags, magic = struct.unpack(FOOTER, file.read_at(FOOTER_SIZE, size - FOOTER_SIZE))
    if magic != SEEKABLE or flags != CHECKSUMS:
        raise ValueError("no seek table with checksums")
    start = size - FOOTER_SIZE - ENTRY_SIZE * count
    entries = np.frombuffer(file.read_at(ENTRY_SIZE * count, start), "<u4").reshape(-1, 3)
    frames = int(entries[:, 0].sum(dtype=np.int64))
    nulls, = struct.unpack("<I", file.read_at(4, frames + 8))
    names = np.frombuffer(file.read_at(8 * (count - nulls), frames + 12), "<i8")
    return names, nulls, entries


def _checked(frame: bytes, entry: np.ndarray, decompressor) -> bytes:
    data = decompressor.decompress(frame, max_output_size=int(entry[1]))
    if len(data) != entry[1] or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != entry[2]:
        raise ValueError("a frame does not match its checksum")
    return data


def read_documents(uri: str, wanted: set[int]) -> dict[int, np.ndarray]:
    """The ids of some documents of one file; only their frames are read."""
    fs, path = file_system(uri)
    found, decompressor = {}, zstandard.ZstdDecompressor()
    with fs.open_input_file(path) as file:
        names, nulls, entries = read_index(file)
        starts = np.concatenate(([0], np.cumsum(entries[:, 0], dtype=np.int64)))
        for i in np.flatnonzero(np.isin(names, list(wanted))):
            entry = entries[nulls + i]
            frame = file.read_at(int(entry[0]), int(starts[nulls + i]))
            found[int(names[i])] = np.frombuffer(_checked(frame, entry, decompressor), "<u4")
    return found


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID
) -> DataFrame:
    """Encodes whole texts with the tokenizer whose JSON file is at ``tokenizer`` on the driver and writes the
    files; returns the manifest: part, path, records (documents), units (ids), bytes."""
    with open(tokenizer, encoding="utf-8") as source:
        definition = source.read()
    shipped = docs.sparkSession.sparkContext.broadcast(definition)
    end = struct.pack("<I", end_id)

    def write(batches: Iterator[pd.DataFrame], stream) -> tuple[int, int]:
        encoder = _encoder(shipped.value)

        def documents() -> Iterator[tuple[int | None, bytes]]:
            for batch in batches:
                for i in range(0, len(batch), AT_ONCE):
                    some = batch.iloc[i : i + AT_ONCE]
                    names = [None if pd.isna(x) else int(x) for x in some["id"]]
                    for name, data in zip(names, encoder.encode(list(some["text"])), strict=True):
                        yield name, data + end

        return write_frames(stream, documents())

    # The id goes along as text, so that a null does not turn a batch's ids into floating-point numbers.
    texts = docs.select(F.col(id_col).cast("long").alias("key"), F.coalesce(text_col, F.lit("")).alias("text"))
    ordered = texts.repartitionByRange("key", F.xxhash64("text")).sortWithinPartitions("key", "text")
    return write_parts(ordered.select(F.col("key").cast("string").alias("id"), "text"), folder, ".ids.zst", write)


def read_token_files(manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """One row per document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and, if asked for,
    ids."""

    def read(row: dict) -> Iterator[pd.DataFrame]:
        fs, path = file_system(row["path"])
        decompressor, start = zstandard.ZstdDecompressor(), int(row["base"])
        with fs.open_input_file(path) as file:
            names, nulls, entries = read_index(file)
            file.seek(0)
            for i in range(0, len(entries), AT_ONCE):
                rows = []
                for k, entry in enumerate(entries[i : i + AT_ONCE], i):
                    data = _checked(file.read(int(entry[0])), entry, decompressor)
                    name = None if k < nulls else int(names[k - nulls])
                    ids = np.frombuffer(data, "<u4").astype("int64") if with_ids else None
                    rows.append((name, start, len(data) // 4, zlib.crc32(data), ids))
                    start += len(data) // 4
                out = pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32", "ids"])
                out["doc_id"] = out["doc_id"].astype("Int64")
                yield out if with_ids else out.drop(columns="ids")

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    return read_parts(with_base(manifest), read, schema)
