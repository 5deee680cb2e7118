"""SentencePiece BPE encoding and decoding of whole texts by a prefix table, without running the merges.

For merge-type vocabularies each prefix of a string has one encoding, and that encoding's last token together with the
shorter prefix before it is enough to write it down. The table stores this last token for every prefix. Candidates are the
vocabulary pieces that an Aho-Corasick automaton finds ending there; a candidate is the last token exactly if it and the
last token before it stay apart when the two are merged alone (a memoised pair test). Ids are recovered backwards.
Runs of spaces tie in score, so their merges are laid out by rule: leftmost first.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evispark.llm import shared
from evispark.llm.textkit import gather, text_bytes
from evispark.llm.vocabulary import UnitStore, kept, spread

SPACE = "▁"
#: Pair tests that a Python worker keeps, about 100 MB, and the longest run of spaces whose ids it keeps.
MOST_PAIRS = 1_000_000
MOST_SPACES = 256


class PieceCodec:
    """Encoder and decoder of one SentencePiece BPE model with byte fallback and an identity normaliser."""

    def __init__(self, model_path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        n = model.get_piece_size()
        self.bos, self.eos = model.bos_id(), model.eos_id()
        special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i) for i in range(n)]
        pieces = [model.id_to_piece(i) for i in range(n)]
        self.bytes_at = next(i for i in range(n) if model.is_byte(i))
        self.ids = {p: i for i, p in enumerate(pieces) if not special[i]}
        self.score = [model.get_score(i) for i in range(n)]
        self.pieces = pieces
        if any(SPACE in p.lstrip(SPACE) or p.startswith(SPACE * 2) and p.strip(SPACE) for p in self.ids):
            raise ValueError("pieces that join words are not supported")
        self.apart: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        for p, i in self.ids.items():
            if p.strip(SPACE) == "" and len(p) > 1:
                continue
            if len(p) == 1 or self.merge(p) == [i]:  # pieces that no merge reaches are never a token
                self.automaton.add_word(p, (i, len(p)))
        self.automaton.make_automaton()
        self.spaces: dict[int, list[int]] = {}
        table = [b"" if model.is_control(i) else bytes([i - self.bytes_at]) if model.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.out_length = np.array([len(x) for x in table], dtype=np.int64)
        self.out_start = np.cumsum(self.out_length) - self.out_length
        self.out = np.frombuffer(b"".join(table), dtype=np.uint8)

    def merge(self, text: str) -> list[int]:
        """Merges by score, of equals the leftmost; only for single pieces, pairs of them and runs of spaces."""
        ids, score = self.ids, self.score
        left, right, part = list(range(-1, len(text) - 1)), list(range(1, len(text) + 1)), list(text)
        heap: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            if i >= 0 and right[i] < len(part) and (k := ids.get(both := part[i] + part[right[i]])) is not None:
                heapq.heappush(heap, (-score[k], i, both))

        for i in range(len(part) - 1):
            offer(i)
        while heap:
            _, i, both = heapq.heappop(heap)
            if part[i] and right[i] < len(part) and part[i] + part[right[i]] == both:
                j = right[i]
                part[i], part[j], right[i] = both, "", right[j]
                if right[i] < len(part):
                    left[right[i]] = i
                offer(left[i])
                offer(i)
        return [ids.get(p, -1) for p in part if p]

    def _apart(self, a: int, b: int) -> bool:
        key = a << 20 | b
        if (known := self.apart.get(key)) is None:
            if len(self.apart) >= MOST_PAIRS:
                self.apart.clear()
            known = self.apart[key] = self.merge(self.pieces[a] + self.pieces[b]) == [a, b]
        return known

    def unit(self, text: str) -> list[int]:
        """Ids of a word, with at most one space sign before it."""
        n = len(text)
        last, size = [-1] * (n + 1), [1] * (n + 1)  # -1: no piece ends here, so the character is spelled in bytes
        apart, get = self._apart, self.apart.get
        for end, (token, length) in self.automaton.iter(text):
            end += 1
            if last[end] >= 0:
                continue
            before = end - length
            prior = last[before]
            if prior >= 0 and before:
                fits = get(prior << 20 | token)
                if not (apart(prior, token) if fits is None else fits):
                    continue
            last[end], size[end] = token, length
        out: list[int] = []
        while n:
            if last[n] >= 0:
                out.append(last[n])
            else:
                out += [self.bytes_at + b for b in reversed(text[n - 1].encode())]
            n -= size[n]
        return out[::-1]

    def run(self, n: int) -> list[int]:
        if n > MOST_SPACES:  # rare and long: not kept
            return self.merge(SPACE * n)
        if n not in self.spaces:
            self.spaces[n] = self.merge(SPACE * n)
        return self.spaces[n]

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text, without begin and end ids."""
        if not text:
            return []
        out: list[int] = []
        bare = self.ids[SPACE]
        for spaces, word in re.findall(f"({SPACE}*)([^{SPACE}]*)", SPACE + text.replace(" ", SPACE)):
            if not word:
                out += self.run(len(spaces)) if spaces else []
                continue
            own = self.unit(SPACE + word if spaces else word)
            if spaces and own[0] == bare:
                out += self.run(len(spaces)) + own[1:]
            else:
                out += (self.run(len(spaces) - 1) if len(spaces) > 1 else []) + own
        return out

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> Iterator[bytes]:
        """Text of each run ids[ends[i]:ends[i + 1]], in UTF-8; the space put before the text is taken off again."""
        size = self.out_length[ids]
        data = self.out[gather(self.out_start[ids], size)].tobytes()
        at = np.concatenate([[0], np.cumsum(size)])[ends]
        for a, b in zip(at[:-1], at[1:], strict=True):
            yield data[a + 1 : b] if data[a : a + 1] == b" " else data[a:b]


def codec_rows(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids with begin and end ids, and the text decoded from them: (doc_id, ids array<int>, decoded).

    Null texts count as empty: two ids, an empty text. Repeated rows come back each; other columns play no part.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc, ids, ends, decoded in _coded(batches, model_path):
            yield pa.RecordBatch.from_arrays([doc, pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32))), pa.array([x.decode("utf-8", "replace") for x in decoded])], names=["doc_id", "ids", "decoded"])

    return _source(docs, id_col, text_col).mapInArrow(shared.tidy(rows), "doc_id long, ids array<int>, decoded string")


def codec_digests(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As codec_rows, with SHA-256 of the ids (little-endian 32-bit) and of the decoded text in place of both."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc, ids, ends, decoded in _coded(batches, model_path):
            data = ids.astype("<u4").tobytes()
            of_ids = [hashlib.sha256(data[4 * a : 4 * b]).hexdigest() for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([doc, pa.array(np.diff(ends)), pa.array(of_ids), pa.array([hashlib.sha256(x).hexdigest() for x in decoded])], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _source(docs, id_col, text_col).mapInArrow(shared.tidy(rows), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    shared.tune(docs.sparkSession)
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))


def _coded(batches: Iterator[pa.RecordBatch], model_path: str):
    codec = kept(("pieces", model_path), lambda: PieceCodec(model_path))

    def encode(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        own = [codec.encode(u) for u in units]  # encode() puts the space sign before each
        return np.fromiter((i for x in own for i in x), dtype=np.uint32), np.fromiter(map(len, own), dtype=np.int64, count=len(own))

    store = UnitStore(encode)
    for batch in batches:
        text = pc.fill_null(batch.column(1), "")
        # a text whose spaces stand alone between words is its words' units in a row; any other one is a single unit
        odd = pc.match_substring_regex(text, f"  |{SPACE}|^ | $|^$").to_numpy(zero_copy_only=False)
        ends_at = np.cumsum(np.diff(text_bytes(text)[1]))
        a = 0
        while a < len(text):
            b = max(a + 1, int(np.searchsorted(ends_at, (ends_at[a - 1] if a else 0) + (4 << 20), side="right")))
            part, strange = text.slice(a, b - a), odd[a:b]
            words = pc.split_pattern(pc.if_else(pa.array(strange), "", part), " ")
            pool, start, length = store.look(words.flatten())
            first = np.concatenate([[0], np.cumsum(words.value_lengths().to_numpy(zero_copy_only=False))])
            flat = spread(pool, start, length)
            at = np.concatenate([[0], np.cumsum(length)])[first]
            pieces, sizes = [], []
            for i in range(b - a):
                own = np.array(codec.encode(part[i].as_py()), dtype=np.uint32) if strange[i] else flat[at[i] : at[i + 1]]
                pieces += [[codec.bos], own, [codec.eos]]
                sizes.append(len(own) + 2)
            ids = np.concatenate(pieces).astype(np.uint32)
            ends = np.concatenate([[0], np.cumsum(sizes)])
            yield batch.column(0).slice(a, b - a), ids, ends, codec.decode(ids, ends)
            a = b
