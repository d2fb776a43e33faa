"""SentencePiece encoding and decoding of whole texts (operator 12) by a merge-type prefix table.

A merge-type (BPE) vocabulary gives every prefix of a string exactly one encoding, so one last token. The table stores that
token for each prefix: an Aho-Corasick automaton names the pieces that end at a place, and the one whose pair with the last
token of the prefix before it is compatible (encoding the two joined gives the two back) is the last token. The ids are
read off backwards from the end of the table. Work is linear in the text, however long a word without blanks is.

No piece holds a blank behind another character, so texts are cut before each run of blanks; inside, they are cut
wherever no piece holds the two neighbouring characters. Segments are kept in a bounded cache of the worker. Runs of blanks
are merged last and leftmost first, as their pieces share one score below all others. Characters without a piece become
byte pieces. Decoding joins the pieces' surfaces in Arrow and takes off the blank that encoding put in front.

Null text counts as empty, which has the end id only; a null id list decodes to null; repeated rows give repeated
results; extra columns stay untouched.
"""

from __future__ import annotations

import codecs
from collections.abc import Iterator
from functools import cached_property
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from giniflow.llm.common import by_bytes, held
from giniflow.llm.tokens import tokenizer_path

MODEL = "piece_bpe_32k.model"
BLANK = "▁"
#: Segments (and parts of segments) kept in a worker's cache, entries that stay when it is full and between tasks,
#: characters of a segment that is kept, pairs of pieces kept.
CACHE_SIZE, KEPT, CACHED_LENGTH, PAIRS = 300_000, 150_000, 40, 500_000
#: Characters of texts encoded together, ids decoded together.
BATCH_CHARS, BATCH_IDS = 1 << 21, 1 << 19

codecs.register_error("each_byte", lambda e: ("�", e.start + 1))


class _Pairs(dict):
    """Whether two pieces may stand side by side, filled on demand."""

    def __init__(self, table: PrefixTable):
        self.table = table

    def __missing__(self, key: int) -> bool:
        if len(self) > PAIRS:
            self.clear()
        a, b = divmod(key, self.table.size)
        pieces = self.table.pieces
        ok = self[key] = self.table.merged([*pieces[a], *pieces[b]]) == [pieces[a], pieces[b]]
        return ok


class PrefixTable:
    """Pieces, automaton and pair test of one merge-type model, and the encoder over them."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = pb.ModelProto()
        proto.ParseFromString(sp.serialized_model_proto())
        norm, kind = proto.normalizer_spec, pb.ModelProto.SentencePiece
        if proto.trainer_spec.model_type != pb.TrainerSpec.BPE or norm.precompiled_charsmap \
                or norm.remove_extra_whitespaces or not norm.add_dummy_prefix or not norm.escape_whitespaces \
                or proto.trainer_spec.treat_whitespace_as_suffix or not proto.trainer_spec.byte_fallback:
            raise ValueError(f"{path}: not a merge-type model with byte pieces and plain blanks")
        if any(p.type not in (kind.NORMAL, kind.BYTE, kind.CONTROL, kind.UNKNOWN) for p in proto.pieces):
            raise ValueError(f"{path}: user-defined or unused pieces")
        self.size, self.end_id = len(proto.pieces), sp.eos_id()
        self.pieces = [p.piece for p in proto.pieces]
        self.ids = {p.piece: k for k, p in enumerate(proto.pieces) if p.type == kind.NORMAL}
        self.byte_ids = {int(p.piece[3:5], 16): k for k, p in enumerate(proto.pieces) if p.type == kind.BYTE}
        self.rank = {p.piece: -p.score for p in proto.pieces if p.type == kind.NORMAL and len(p.piece) > 1}
        words = [p for p in self.rank if p.strip(BLANK)]
        runs = [p for p in self.rank if not p.strip(BLANK)]
        if any(BLANK in p[1:] for p in words) or len({self.rank[p] for p in words}) < len(words):
            raise ValueError(f"{path}: pieces with blanks inside or equal scores")
        if runs and (len({self.rank[p] for p in runs}) > 1 or self.rank[runs[0]] <= max(map(self.rank.get, words))):
            raise ValueError(f"{path}: pieces of blanks are not merged last")
        self.runs = {len(p): self.ids[p] for p in runs} | {1: self.ids[BLANK]}
        #: What a piece stands for in a decoded text; control pieces stand for nothing.
        self.surfaces = pa.array([p.piece.replace(BLANK, " ").encode() if p.type == kind.NORMAL
                                  else bytes([int(p.piece[3:5], 16)]) if p.type == kind.BYTE
                                  else proto.trainer_spec.unk_surface.encode() if p.type == kind.UNKNOWN else b""
                                  for p in proto.pieces], pa.binary())
        self.neighbours = {x + y for p in words for x, y in zip(p, p[1:])}
        self.pairs = _Pairs(self)
        self.parts: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}

    @cached_property
    def automaton(self):
        """The pieces that may be last tokens; only encoding needs it."""
        import ahocorasick
        found = ahocorasick.Automaton()
        for p, k in self.ids.items():
            if len(p) == 1 or (p.strip(BLANK) and self.merged([*p]) == [p]):  # others are no last token ever
                found.add_word(p, (k, len(p)))
        found.make_automaton()
        return found

    def merged(self, symbols: list[str]) -> list[str]:
        """The merges carried out one by one, best score first, on a few characters: the definition."""
        rank = self.rank
        while len(symbols) > 1:
            best, at = min((rank.get(x + y, float("inf")), k) for k, (x, y) in enumerate(zip(symbols, symbols[1:])))
            if best == float("inf"):
                break
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def last_tokens(self, part: str) -> list[int]:
        """The last token of each prefix of ``part`` (by its length), whose characters all have pieces."""
        last, pairs, size = [-1] * (len(part) + 1), self.pairs, self.size
        for end, (token, length) in self.automaton.iter(part):
            end += 1
            if last[end] < 0:
                begin = end - length
                if not begin or pairs[last[begin] * size + token]:
                    last[end] = token
        return last

    def _part(self, part: str) -> bytes:
        """Ids of a part without cuts; a character that has no piece is a part of its own."""
        if len(part) == 1 and part not in self.ids:
            return np.array([self.byte_ids[b] for b in part.encode()], "<u4").tobytes()
        last, end, out = self.last_tokens(part), len(part), []
        while end:
            out.append(last[end])
            end -= len(self.pieces[last[end]])
        return np.array(out[::-1], "<u4").tobytes()

    def _blanks(self, n: int) -> list[int]:
        """Pieces of ``n`` blanks that no word takes: the leftmost pair that is a piece is merged first."""
        stack: list[int] = []
        for _ in range(n):
            stack.append(1)
            while len(stack) > 1 and stack[-2] + stack[-1] in self.runs:
                stack[-2:] = [stack[-2] + stack[-1]]
        return [self.runs[k] for k in stack]

    def _segment(self, segment: str) -> bytes:
        """Ids of a run of blanks and the characters behind it."""
        word = segment.lstrip(" ")
        blanks = len(segment) - len(word)
        text, near, begin, ids = BLANK + word, self.neighbours, 0, []
        cuts = [k for k in range(1, len(text)) if text[k - 1:k + 1] not in near]
        for end in [*cuts, len(text)]:
            part = text[begin:end]
            found = self.parts.get(part)
            if found is None:
                found = self._part(part)
                if len(part) <= CACHED_LENGTH:
                    self.parts[part] = found
            ids.append(found)
            begin = end
        first = ids[0][:4]
        if first == np.array(self.ids[BLANK], "<u4").tobytes():  # the last blank stays with the others
            ids[0] = ids[0][4:]
        else:
            blanks -= 1
        return np.array(self._blanks(blanks), "<u4").tobytes() + b"".join(ids) if blanks else b"".join(ids)

    def look_up(self, segments: list[str]) -> list[bytes]:
        if len(self.known) > CACHE_SIZE or len(self.parts) > CACHE_SIZE:
            self.trim()
        known = self.known
        out = list(map(known.get, segments))
        fresh: dict[str, bytes] = {}
        for k, v in enumerate(out):
            if v is None:
                s = segments[k]
                got = fresh.get(s)
                if got is None:
                    got = fresh[s] = self._segment(s)
                out[k] = got
        known.update((s, v) for s, v in fresh.items() if len(s) <= CACHED_LENGTH)
        return out

    def trim(self) -> None:
        """Keep the entries met first, so the frequent ones."""
        for name in ("known", "parts"):
            if len(getattr(self, name)) > KEPT:
                setattr(self, name, dict(islice(getattr(self, name).items(), KEPT)))

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each whole text, the end id behind them. The different segments of all texts
        are numbered by Arrow, so Python sees each once."""
        end = np.array(self.end_id, "<u4").tobytes()
        full = [k for k, t in enumerate(texts) if t]
        out = [end] * len(texts)
        if not full:
            return out
        # a blank in front of each text and each run of blanks; the cut stands before the run
        cut = pc.split_pattern(pa.array([_marked(texts[k]) for k in full], pa.large_string()), "\x00\x00")
        numbered = cut.values.dictionary_encode()
        codes, starts = numbered.indices.to_numpy(), cut.offsets.to_numpy()
        values = self.look_up([s.replace("\x00\x01", "\x00") for s in numbered.dictionary.to_pylist()])
        lengths = np.fromiter(map(len, values), np.int64, len(values)) // 4
        table, place = np.frombuffer(b"".join(values), "<u4"), np.cumsum(lengths) - lengths
        n = lengths[codes]
        ends = np.cumsum(n)
        flat = table[np.repeat(place[codes] - (ends - n), n) + np.arange(ends[-1])]
        bounds = np.concatenate(([0], ends))[starts - starts[0]]
        for k, a, b in zip(full, bounds, bounds[1:]):
            out[k] = flat[a:b].tobytes() + end
        return out

    def decode_many(self, ids: pa.ListArray) -> pa.Array:
        """Texts of id lists; bytes that are no UTF-8 become one replacement character each."""
        flat = ids.flatten()
        if len(flat) and not 0 <= pc.min(flat).as_py() <= pc.max(flat).as_py() < self.size:
            raise ValueError("ids outside the vocabulary")
        lists = pa.ListArray.from_arrays(_offsets(ids), self.surfaces.take(flat))
        joined = pc.binary_join(lists, b"").to_pylist()
        out = [x[x.startswith(b" "):].decode("utf-8", "each_byte") for x in joined]
        return pa.array(out, pa.string(), mask=ids.is_null().to_numpy(zero_copy_only=False))


def _marked(text: str) -> str:
    """The text with a blank in front and a mark (two zeros) before each later run of blanks; its own zeros
    get a one behind them, so that no mark is read that was not set."""
    text = " " + text.replace(BLANK, " ")
    if "\x00" in text:
        text = text.replace("\x00", "\x00\x01")
    if "  " not in text:
        return text[0] + text[1:].replace(" ", "\x00\x00 ")
    import re
    return re.sub(r"(?<=[^ ])(?= )", "\x00\x00", text)


def _offsets(ids: pa.ListArray) -> pa.Array:
    lengths = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
    return pa.array(np.concatenate(([0], np.cumsum(lengths))), pa.int32())


def prefix_table(path: str) -> PrefixTable:
    """One table per worker process, so that its cache serves all tasks of the worker."""
    return held(("pieces", path), lambda: PrefixTable(path))


def encode_pieces(text: Column, model: str = MODEL) -> Column:
    """Ids of each whole text with the end id behind them, as the library gives them; null counts as empty."""

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = prefix_table(tokenizer_path(model))
        for batch in batches:
            found = [x for some in by_bytes([t or "" for t in batch.to_pylist()], BATCH_CHARS)
                     for x in table.encode_many(some)]
            sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
            offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
            yield pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(found), "<i4")))
        table.trim()

    return encode(text)


def decode_pieces(ids: Column, model: str = MODEL) -> Column:
    """Text of each list of ids, as the library decodes it."""

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = prefix_table(tokenizer_path(model))
        for batch in batches:
            n = max(1, BATCH_IDS * max(len(batch), 1) // max(len(batch.flatten()), 1))
            yield pa.concat_arrays([table.decode_many(batch.slice(k, n)) for k in range(0, len(batch), n)]
                                   or [pa.array([], pa.string())])

    return decode(ids)


def encode_documents(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", model: str = MODEL) -> DataFrame:
    """doc_id, ids, decoded for every row of ``docs``."""
    ids = encode_pieces(F.coalesce(F.col(text_col), F.lit("")), model)
    return (docs.select(F.col(id_col).alias("doc_id"), ids.alias("ids"))
            .withColumn("decoded", decode_pieces(F.col("ids"), model)))


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids with a space between), decoded_sha256."""
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))
