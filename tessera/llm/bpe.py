"""Byte-level BPE encoding and decoding as finite-state machines.

Encoding. A byte-pair encoding of a string is the only way to cut it into
vocabulary tokens such that no two neighbours would ever have merged across
their border. That makes the encoder a nondeterministic transducer: a
configuration is (last token, bytes of the token now being read, tokens not
yet written), reading a byte extends the token being read, and a finished
token that stays separate from the last one starts a new configuration.
:class:`Transducer` determinises it lazily: a state is the set of live
configurations with the tokens they all share taken out, which are emitted at
that moment. Live configurations start within the longest token's length of
each other, so output follows input after a bounded lookahead, and the work
per byte is one lookup in the state's own moves once they are known. All
states are given up when there are ``max_states``; they are then built again,
with the same results.

Decoding. :class:`Decoder` runs an incremental UTF-8 state machine over token
bytes, so text comes out token by token; a state is the bytes of a character
still incomplete (three at most). A malformed sequence gives U+FFFD for each
maximal part of it, as the Unicode standard recommends.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Pieces that a worker remembers, twice; states and token pairs are in proportion. When full about 360 MB a worker,
#: as measured before pre-tokens were remembered too; not measured since.
REMEMBER = 500_000
#: Code points of the longest piece or pre-token remembered.
SHORT = 32
NEVER = float("inf")
BYTE = [bytes([b]) for b in range(256)]
NO_MOVES: dict = {}
#: A space after white space: found by its space, as that is quicker to look for.
SPACE_AFTER_WHITE = re.compile(r" (?<=\s )")


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of ``base64 rank`` lines."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class State(dict):
    """A state of a :class:`Transducer`: by byte, the next state and the tokens emitted; missing moves are made."""

    __slots__ = ("subset", "end", "machine")

    def __init__(self, subset: tuple, end: tuple, machine: Transducer):
        self.subset, self.end, self.machine = subset, end, machine

    def __missing__(self, byte: int) -> tuple[State, tuple]:
        return self.machine._move(self, byte)


class Transducer:
    """Lazily determinised encoder for one pre-token at a time."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = 400_000, max_pairs: int = 2_000_000):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.max_states, self.max_pairs = max_states, max_pairs
        # the prefixes of all tokens, numbered, the empty one 0: by 256 * prefix + byte the longer prefix; its rank or None
        self.longer: dict[int, int] = {}
        self.rank_at: list[int | None] = [None]
        self.extends: list[bool] = [True]  # whether a longer token starts with it
        for token, rank in ranks.items():
            at = 0
            for byte in token:
                self.extends[at] = True
                step = at << 8 | byte
                at = self.longer.get(step)
                if at is None:
                    at = self.longer[step] = len(self.rank_at)
                    self.rank_at.append(None)
                    self.extends.append(False)
            self.rank_at[at] = rank
        self._halves: dict[int, tuple[int, int] | None] = {}
        self.width = max(ranks.values()) + 1
        self._separate: dict[int, bool] = {}  # by width * left token + right token
        self.states: dict[tuple, State] = {}
        self._clear()

    def _clear(self) -> None:
        for state in self.states.values():
            state.clear()  # states lead to each other
        self.states.clear()
        self.start = self._state(((None, 0, ()),), ())

    def _state(self, subset: tuple, end: tuple | None) -> State:
        """The state of these configurations; ``end``: the tokens to write if the pre-token ends here."""
        known = self.states.get(subset)
        if known is None:
            known = self.states[subset] = State(subset, end, self)
        return known

    # -- which tokens may stand side by side ---------------------------------

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge made ``token``; None for a single byte."""
        if token not in self._halves:
            parts = [self.ranks[BYTE[b]] for b in self.bytes_of[token]]
            while len(parts) > 2:
                joined = [self.ranks.get(self.bytes_of[a] + self.bytes_of[b], NEVER) for a, b in zip(parts, parts[1:])]
                at = min(range(len(joined)), key=joined.__getitem__)
                if joined[at] == NEVER:
                    raise ValueError(f"token {token} is not reachable by merges")
                parts[at:at + 2] = [joined[at]]
            self._halves[token] = tuple(parts) if len(parts) == 2 else None
        return self._halves[token]

    def separate(self, left: int, right: int) -> bool:
        """Whether ``left`` followed by ``right`` is how their joint bytes are encoded.

        Goes back in time from the finished tokens: at each moment the border
        has one piece on either side, each of which lasts until it merges with
        its own other half. The tokens are not separate if some such pair of
        pieces would have merged with each other before that.
        """
        pair = left * self.width + right
        known = self._separate.get(pair)
        if known is not None:
            return known
        a, b, end_a, end_b, apart = left, right, NEVER, NEVER, True
        ranks, bytes_of, halves = self.ranks, self.bytes_of, self._halves
        while True:
            joined = ranks.get(bytes_of[a] + bytes_of[b])
            if joined is not None and joined < end_a and joined <= end_b:  # equal ranks merge from the left
                apart = False
                break
            parts_a = halves[a] if a in halves else self.halves(a)
            parts_b = halves[b] if b in halves else self.halves(b)
            if parts_a is None and parts_b is None:
                break
            if parts_b is None or parts_a is not None and a > b:
                a, end_a = parts_a[1], a
            else:
                b, end_b = parts_b[0], b
        if len(self._separate) >= self.max_pairs:
            self._separate.clear()
        self._separate[pair] = apart
        return apart

    # -- the transducer ------------------------------------------------------

    def _move(self, state: State, byte: int) -> tuple[State, tuple]:
        live, end = [], None
        longer, rank_at, extends, known, width = self.longer, self.rank_at, self.extends, self._separate, self.width
        for last, piece, tail in state.subset:
            piece = longer.get(piece << 8 | byte)
            if piece is None:
                continue
            if extends[piece]:
                live.append((last, piece, tail))
            if end is None:  # what was read so far has one encoding
                token = rank_at[piece]
                if token is not None:
                    apart = True if last is None else known.get(last * width + token)
                    if apart is None:
                        apart = self.separate(last, token)
                    if apart:
                        end = *tail, token
                        live.append((token, 0, end))
        # the tokens that all live configurations begin with are certain
        emitted = live[0][2]
        for _, _, tail in live:
            if not emitted:
                break
            while tail[:len(emitted)] != emitted:
                emitted = emitted[:-1]
        if emitted:
            shared = len(emitted)
            live = [(last, piece, tail[shared:]) for last, piece, tail in live]
            end = end and end[shared:]
        subset = tuple(live)
        if len(self.states) >= self.max_states and subset not in self.states:
            self._clear()
            return self._state(subset, end), emitted
        move = state[byte] = self._state(subset, end), emitted
        return move

    def encode(self, data: Iterable[int]) -> Iterator[int]:
        """Token ids of one pre-token's bytes, each emitted as soon as it is certain."""
        state = self.start
        for byte in data:
            state, emitted = state[byte]
            yield from emitted
        yield from state.end

    def encode_all(self, data: bytes) -> list[int]:
        """:meth:`encode` as a list, without a generator's cost."""
        state, out = self.start, []
        for byte in data:
            state, emitted = state[byte]
            if emitted:
                out += emitted
        out += state.end
        return out


def _allowed_next(pending: bytes) -> tuple[int, int, int]:
    """For an incomplete character: bytes still missing, and the range its next byte must be in."""
    lead, have = pending[0], len(pending)
    length = 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
    low, high = 0x80, 0xBF
    if have == 1:  # no overlong forms, surrogates or code points past U+10FFFF
        low, high = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}.get(lead, (low, high))
    return length - have, low, high


def utf8_step(pending: bytes, byte: int) -> tuple[bytes, str]:
    """One move of the UTF-8 machine: the new incomplete bytes and the text they complete."""
    text = ""
    if pending:
        missing, low, high = _allowed_next(pending)
        if low <= byte <= high:
            pending += bytes([byte])
            return (b"", pending.decode("utf-8")) if missing == 1 else (pending, "")
        text = "�"
    if byte < 0x80:
        return b"", text + chr(byte)
    if 0xC2 <= byte <= 0xF4:
        return bytes([byte]), text
    return b"", text + "�"


class Decoder:
    """Streaming decoder: the UTF-8 machine composed with the vocabulary, lazily."""

    def __init__(self, bytes_of: dict[int, bytes]):
        self.bytes_of = bytes_of
        self.moves: dict[bytes, dict[int, tuple[bytes, str]]] = {}
        self.whole: dict[int, str] = {}  # moves from the resting state to itself
        self._table: tuple[np.ndarray, pa.Array] | None = None

    def _move(self, pending: bytes, token: int) -> tuple[bytes, str]:
        now, parts = pending, []
        for byte in self.bytes_of[token]:
            now, text = utf8_step(now, byte)
            parts.append(text)
        move = self.moves.setdefault(pending, {})[token] = now, "".join(parts)
        if not pending and not now:
            self.whole[token] = move[1]
        return move

    def decode(self, tokens: Iterable[int]) -> Iterator[str]:
        """Text of a stream of ids, piece by piece; an incomplete end gives U+FFFD."""
        pending, table = b"", self.moves.setdefault(b"", {})
        for token in tokens:
            move = table.get(token)
            now, text = self._move(pending, token) if move is None else move
            if now != pending:
                pending, table = now, self.moves.setdefault(now, {})
            yield text
        if pending:
            yield "�"

    def table(self) -> tuple[np.ndarray, pa.Array]:
        """By token: whether it moves from the resting state to itself, and the text of such a move as UTF-8."""
        if self._table is None:
            texts = [b""] * (max(self.bytes_of) + 1)
            whole = np.zeros(len(texts), bool)
            for token in self.bytes_of:
                now, text = self._move(b"", token)
                if not now:
                    whole[token], texts[token] = True, text.encode("utf-8")
            self._table = whole, pa.array(texts, pa.large_binary())
        return self._table

    def decode_all(self, ids: Sequence[int], run: int = 256) -> str:
        """:meth:`decode` as one string, by runs of ids.

        A run whose tokens all begin and end between characters needs only the
        machine's moves out of its resting state.
        """
        out, pending = [], b""
        for at in range(0, len(ids), run):
            part = ids[at:at + run]
            if not pending:
                try:
                    out.append("".join(map(self.whole.__getitem__, part)))
                    continue
                except KeyError:
                    pass
            for token in part:
                pending, text = self.moves.get(pending, NO_MOVES).get(token) or self._move(pending, token)
                out.append(text)
        if pending:
            out.append("�")
        return "".join(out)

    def decode_bytes(self, ids: np.ndarray) -> bytes | memoryview:
        """:meth:`decode` as UTF-8: moves of :meth:`table`, and the machine token by token where a character is cut."""
        whole, texts = self.table()
        data, ends = gathered(texts, ids)  # cut tokens have no text there
        cuts = np.flatnonzero(~whole[ids]).tolist()
        if not cuts:
            return data
        out, pending, at = [], b"", 0
        for cut in cuts:
            if cut < at:
                continue  # read with the cut before
            out.append(data[ends[at]:ends[cut]])
            at = cut
            while at < len(ids) and (pending or at == cut):
                token = int(ids[at])
                pending, text = self.moves.get(pending, NO_MOVES).get(token) or self._move(pending, token)
                out.append(text.encode("utf-8"))
                at += 1
        out.append("�".encode() if pending else data[ends[at]:])
        return b"".join(out)


def gathered(strings: pa.LargeBinaryArray, at: np.ndarray) -> tuple[memoryview, np.ndarray]:
    """The strings at these places, one after another, and where each starts, with the end of all."""
    _, ends, data = strings.take(pa.array(at)).buffers()
    starts = np.frombuffer(ends, np.int64, len(at) + 1) if len(at) else np.zeros(1, np.int64)
    return memoryview(data or b"")[:starts[-1]], starts


class Remembered(dict):
    """A bounded map of what ``make`` gives that forgets what was not asked for lately: two generations of ``size``.

    ``make`` gives a key's value and whether to remember it.
    """

    def __init__(self, size: int, make: Callable[[str], tuple[bytes, bool]]):
        self.size, self.make, self.old = size, make, {}

    def __missing__(self, key: str) -> bytes:
        value, keep = self.old.get(key), True
        if value is None:
            value, keep = self.make(key)
        if keep:
            if len(self) >= self.size:
                self.old.clear()
                self.old.update(self)
                self.clear()
            self[key] = value
        return value


class Codec:
    """Pre-tokeniser, transducer and decoder together; one per Python worker.

    No pre-token of the byte-level pattern holds a space after a character that
    isn't white space, so a text may be cut before each such space and the
    outputs of short pieces remembered, up to ``remember`` twice, if they have
    at most two pre-tokens; of the pre-tokens in other pieces half as many are
    remembered. The transducer's tables are bounded in proportion.
    ``spaces_cut=False`` is for patterns without that property.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, remember: int = REMEMBER, spaces_cut: bool = True):
        self.find = regex.compile(pattern).findall
        self.transducer = Transducer(ranks, max_states=remember * 4 // 5, max_pairs=remember * 4)
        self.decoder = Decoder(self.transducer.bytes_of)
        self.pieces = Remembered(remember, self._piece)
        self.words = Remembered(max(1, remember // 2), self._word)
        self.spaces_cut = spaces_cut
        self.names = pa.array([b"%d " % i for i in range(self.transducer.width)], pa.large_binary())

    def _word(self, word: str) -> tuple[bytes, bool]:
        """Ids of one pre-token."""
        return array("i", self.transducer.encode_all(word.encode("utf-8"))).tobytes(), len(word) <= SHORT

    def _piece(self, piece: str) -> tuple[bytes, bool]:
        """Ids of one piece with the space before it."""
        text = " " + piece
        words = [text] if piece.isalpha() else self.find(text)  # letters only are one pre-token
        if len(words) == 1:
            return self._word(words[0])
        return b"".join(self._words(words)), len(words) == 2 and len(piece) <= SHORT

    def _words(self, words: list[str]) -> Iterator[bytes]:
        pieces, remembered = self.pieces, self.words
        for word in words:
            ids = pieces.get(word[1:]) if word[0] == " " and self.spaces_cut else None
            yield remembered[word] if ids is None else ids

    def packed(self, text: str | None) -> bytes:
        """Ids of a text as C ints."""
        if not text:
            return b""
        if not self.spaces_cut or SPACE_AFTER_WHITE.search(text):
            return b"".join(self._words(self.find(text)))
        first, *pieces = text.split(" ")
        return b"".join(chain(self._words(self.find(first)), map(self.pieces.__getitem__, pieces)))

    def encode(self, text: str | None) -> list[int]:
        return array("i", self.packed(text)).tolist()

    def decode(self, ids: list[int]) -> str:
        return self.decoder.decode_all(ids)


def digests(ids: np.ndarray, codec: Codec) -> dict:
    """Token count and the hashes of the ids and of the bytes that they decode to."""
    return {
        "n_tokens": len(ids),
        "ids_sha256": hashlib.sha256(gathered(codec.names, ids)[0][:-1]).hexdigest(),
        "decoded_sha256": hashlib.sha256(codec.decoder.decode_bytes(ids)).hexdigest(),
    }


DIGESTS = T.StructType([
    T.StructField("n_tokens", T.LongType()),
    T.StructField("ids_sha256", T.StringType()),
    T.StructField("decoded_sha256", T.StringType()),
])
TOKENS = T.StructType([
    T.StructField("n_tokens", T.LongType()),
    T.StructField("token_ids", T.ArrayType(T.IntegerType())),
])


def tokens(ids: np.ndarray, codec: Codec) -> dict:
    return {"n_tokens": len(ids), "token_ids": ids}


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


_CODECS: dict[tuple, Codec] = {}


def encode(docs: DataFrame, text: str = "text", path: str | None = None, pattern: str | None = None,
           emit: Callable[[np.ndarray, Codec], dict] = tokens, schema: T.StructType = TOKENS,
           remember: int = REMEMBER) -> DataFrame:
    """``docs`` with the columns that ``emit`` makes of each row's token ids.

    ``path`` names a rank file and ``pattern`` the pre-token pattern; without
    them the 50k byte-level vocabulary is used. Each match of ``pattern`` is
    encoded on its own, without special tokens. By default the new columns are
    ``n_tokens`` and ``token_ids``; a column of ``docs`` with such a name is
    replaced. The driver reads the rank file and broadcasts it (under 1 MB for
    50k tokens), so executors need no copy. The plan is one narrow pass:
    no shuffle, and a worker holds one Arrow batch and tables bounded by
    ``remember``, which changes memory and time, never the output.

    Null and empty texts have no tokens. Other columns, repeated rows and null
    ids pass unchanged; an empty table gives an empty table.
    """
    spark = docs.sparkSession
    path, pattern = path or public_tokenizers.path(VOCABULARY), pattern or public_tokenizers.PATTERN
    vocabulary = spark.sparkContext.broadcast(read_ranks(path))
    kept = docs.drop(*[f.name for f in schema.fields])
    out_schema = T.StructType([*kept.schema.fields, *schema.fields])
    new = _arrow(schema)
    at = kept.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = path, pattern, remember
        if key not in _CODECS:
            _CODECS.clear()  # one codec a worker
            pa.default_memory_pool().release_unused()  # what the worker's earlier tasks left
            _CODECS[key] = Codec(vocabulary.value, pattern, remember)
        codec = _CODECS[key]
        for batch in batches:
            for start in range(0, batch.num_rows, 512):  # the ids of 512 documents at a time
                part = batch.slice(start, 512)
                made = [emit(np.frombuffer(codec.packed(x.as_py()), np.intc), codec) for x in part.column(at)]
                columns = [pa.array([m[f.name] for m in made], type=f.type) for f in new]
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=out_schema.names)

    return kept.mapInArrow(run, out_schema)


def decode(encoded: DataFrame, ids: str = "token_ids", to: str = "decoded", path: str | None = None) -> DataFrame:
    """``encoded`` with column ``to``: the text its ids decode to (null ids: empty text)."""
    vocabulary = encoded.sparkSession.sparkContext.broadcast(read_ranks(path or public_tokenizers.path(VOCABULARY)))
    kept = encoded.drop(to)
    at = kept.columns.index(ids)
    out_schema = T.StructType([*kept.schema.fields, T.StructField(to, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder({rank: token for token, rank in vocabulary.value.items()})
        for batch in batches:
            texts = ["".join(decoder.decode(x.as_py() or ())) for x in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=out_schema.names)

    return kept.mapInArrow(run, out_schema)


def op1_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded by the 50k byte-level vocabulary and decoded again, as digests."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    made = encode(docs, emit=digests, schema=DIGESTS)
    return made.select("doc_id", F.col("n_tokens"), "ids_sha256", "decoded_sha256")
