"""BPE encoding and decoding by forced-boundary splitting.

A byte pair that occurs inside no vocabulary token can never be merged, so the
place between its two bytes is a certain cut: the fragments on either side are
encoded independently and their ids concatenated. The ends of pre-tokenised pieces
are certain cuts as well, which lets a task remember the ids of the pieces it met.
Texts in Latin-1 are split into pieces by one expression; in others the chunks between
white space are remembered too, and only new ones are normalised and pre-tokenised.

Defined results: a NULL or empty text has no ids and decodes to the empty text;
all other columns pass through, and input columns named like an output column
are replaced.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from headway.llm.common import in_text_batches

CACHE_BYTES = 48 << 20      # remembered pieces and chunks of a task; beyond it those of the last texts stay
CHUNK = "\n"                # marks chunks, which may be spelt like a piece that is normalised in another way
ENTRY_BYTES = 200           # of a remembered one, besides its characters and ids
OUT_CHARS = 1_000_000       # characters of text encoded and returned at a time
BYTE_CHARS = 512            # the characters that stand for bytes are below this code point
CONTROL = re.compile("[\x1c-\x1f]")
UNICODE_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")

# the vocabulary's pre-tokenisation, for lower-cased Latin-1: its letters, digits, and all but white space
LETTERS, DIGITS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe"
PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{DIGITS}]|[^{LETTERS}{DIGITS}\t-\r \x85\xa0]+")
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_codes() -> np.ndarray:
    """Character that stands for each byte: itself if printable, else the next one from 256 on."""
    own = np.zeros(256, bool)
    for first, last in (("!", "~"), ("\xa1", "\xac"), ("\xae", "\xff")):
        own[ord(first):ord(last) + 1] = True
    return np.where(own, np.arange(256), 255 + np.cumsum(~own)).astype("<u2")


BYTE_CODES = byte_codes()


class Encoder:
    """Encodes whole texts with one vocabulary file of the tokenizers library."""

    def __init__(self, vocab_path: str):
        from tokenizers import Regex, Tokenizer
        from tokenizers.models import BPE
        from tokenizers.pre_tokenizers import Split

        whole = Tokenizer.from_file(vocab_path)
        spec = json.loads(whole.to_str())
        model = spec["model"]
        suffix = model["end_of_word_suffix"] or ""
        first, *others = spec["pre_tokenizer"]["pretokenizers"]
        assert first["pattern"] == {"Regex": PATTERN} and [o["type"] for o in others] == ["ByteLevel"]
        self.normalizer = whole.normalizer
        self.splitter = Split(Regex(PATTERN), "removed", invert=True)
        # the last fragment of a piece carries the word end, the others do not
        self.models = (Tokenizer(BPE(model["vocab"], [tuple(m) for m in model["merges"]])), Tokenizer(whole.model))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_re = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.token = pa.array([whole.id_to_token(i) for i in range(whole.get_vocab_size())])
        self.joined = np.zeros((BYTE_CHARS, BYTE_CHARS), bool)      # byte pairs inside some token
        for token in model["vocab"]:
            codes = [ord(c) for c in (token.removesuffix(suffix) if suffix else token)]
            self.joined[codes[:-1], codes[1:]] = True
        self.forget()

    def forget(self, but: set[str] = frozenset()) -> None:
        """Remember the special tokens and ``but`` only."""
        kept = {k: self.ids[k] for k in but}
        self.ids: dict[str, bytes] = {t: np.int32(i).tobytes() for t, i in self.special.items()} | kept
        self.size = sum(map(len, self.ids)) + sum(map(len, self.ids.values())) + ENTRY_BYTES * len(self.ids)

    def split(self, text: str) -> list[str]:
        """The pieces of a text in Latin-1, the chunks of another; special tokens as they are."""
        if self.special_re is not None and "<|" in text:
            return [c for part in self.special_re.split(text)
                    for c in ([part] if part in self.special else self.split_plain(part))]
        return self.split_plain(text)

    def split_plain(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            # control characters are white space to str.split, but not to the vocabulary
            chunks = [c for c in UNICODE_SPACE.split(text) if c] if CONTROL.search(text) else text.split()
            return [CHUNK + c for c in chunks]
        return PIECE.findall(text.lower())

    def remember(self, key: str, ids: bytes) -> None:
        self.ids[key] = ids
        self.size += len(key) + len(ids) + ENTRY_BYTES

    def learn_chunks(self, new: list[str]) -> None:
        """Pre-tokenise chunks, learn their new pieces and remember their ids."""
        normal = self.normalizer.normalize_str(" ".join([c.removeprefix(CHUNK) for c in new]))
        starts = np.cumsum([0, *(len(c) + 1 for c in normal.split(" "))])
        assert len(starts) == len(new) + 1
        pieces, spans = zip(*self.splitter.pre_tokenize_str(normal))
        chunk = np.searchsorted(starts, [s[0] for s in spans], "right") - 1
        ends = np.cumsum(np.bincount(chunk, minlength=len(new))).tolist()
        unknown = set(pieces).difference(self.ids)
        if unknown:
            self.learn(list(unknown))
        begin = 0
        for c, end in zip(new, ends):
            self.remember(c, b"".join([self.ids[p] for p in pieces[begin:end]]))
            begin = end

    def learn(self, new: list[str]) -> None:
        """Encode pieces and remember their ids (int32 bytes)."""
        raw = "".join(new).encode()
        text = BYTE_CODES[np.frombuffer(raw, np.uint8)].tobytes().decode("utf-16-le")
        codes = np.frombuffer(text.encode("utf-16-le"), np.uint16)
        piece_end = np.cumsum(list(map(len, new)) if raw.isascii() else [len(p.encode()) for p in new])
        # certain cuts: byte pairs inside no token, and the ends of pieces
        cut = np.append(~self.joined[codes[:-1], codes[1:]], True)
        cut[piece_end - 1] = True
        to = np.nonzero(cut)[0] + 1
        at = np.concatenate([[0], to[:-1]])
        piece = np.searchsorted(piece_end, at, "right")
        last = to == piece_end[piece]
        ids, fragment = [], []
        for model, which in zip(self.models, (~last, last)):
            own = np.nonzero(which)[0]
            if len(own):
                got = model.encode([text[a:b] for a, b in zip(at[own].tolist(), to[own].tolist())],
                                   is_pretokenized=True, add_special_tokens=False)
                ids.append(np.array(got.ids, np.int32))
                fragment.append(own[np.array(got.word_ids)])
        fragment = np.concatenate(fragment)
        order = np.argsort(fragment, kind="stable")
        ends = (4 * np.cumsum(np.bincount(piece[fragment[order]], minlength=len(new)))).tolist()
        raw, begin = np.concatenate(ids)[order].tobytes(), 0
        for p, end in zip(new, ends):
            self.remember(p, raw[begin:end])
            begin = end

    def encode(self, texts: list[str]) -> pa.ListArray:
        """Token ids of each text."""
        split = [self.split(t) for t in texts]
        met = set().union(*split)
        new = met.difference(self.ids)
        chunks = [c for c in new if c[0] == CHUNK]
        if chunks:
            self.learn_chunks(chunks)
        new.difference_update(chunks, self.ids)
        if new:
            self.learn(list(new))
        known = self.ids
        ids = [b"".join([known[c] for c in chunks]) for chunks in split]
        ends = np.cumsum([0, *(len(i) // 4 for i in ids)])
        if self.size > CACHE_BYTES:
            self.forget(met if 2 * len(met) < len(known) else frozenset())
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(ids), np.int32)))

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """Decoded texts: the vocabulary has no decoder, so tokens are joined by spaces."""
        tokens = pa.ListArray.from_arrays(ids.offsets, self.token.take(ids.values))
        return pc.binary_join(tokens, " ")


@lru_cache(maxsize=2)
def encoder(vocab_path: str) -> Encoder:
    return Encoder(vocab_path)


def encode_decode(df: DataFrame, vocab_path: str, text_col: str = "text",
                  ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """``df`` with the token ids (array of int) and the decoded text of ``text_col``."""
    kept = [f for f in df.schema.fields if f.name not in (ids_col, decoded_col)]
    schema = T.StructType([*kept, T.StructField(ids_col, T.ArrayType(T.IntegerType(), False)),
                           T.StructField(decoded_col, T.StringType())])
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocab_path)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            at = 0
            while at < batch.num_rows:
                part, size, end = [], 0, at
                while end < batch.num_rows and size < OUT_CHARS:
                    part.append(texts[end].as_py() or "")
                    size += len(part[-1])
                    end += 1
                ids = enc.encode(part)
                arrays = [batch.column(batch.schema.get_field_index(n)).slice(at, end - at) for n in names]
                arrays += [ids, enc.decode(ids)]
                yield pa.RecordBatch.from_arrays(arrays, names=[*names, ids_col, decoded_col])
                at = end
        enc.forget()                            # the worker may serve other stages next

    return in_text_batches(df).mapInArrow(run, schema)
