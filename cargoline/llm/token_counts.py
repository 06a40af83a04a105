"""Token counts of byte-level BPE by finite-state transducers.

Two deterministic transducers do the work:

* the *splitter* reads character classes and marks on its transitions where a pre-token
  begins.  Texts are cut into chunks; each chunk gives a map from every state it may be
  entered in to the state it is left in, and these maps compose by a parallel prefix scan,
  which yields the true entry state of every chunk;
* the *counter* reads the bytes of a pre-token.  Its states are compiled on demand: a
  state is the longest suffix read that begins some token, with the last token of the
  encoding up to each place in that suffix.  Every transition carries the change in the
  number of tokens (-, 0 or +), so the sum along a pre-token is its token count.
"""
from __future__ import annotations

import json

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargoline.llm.common import group_keys, per_worker, short_keys, slices, text_bytes

# Character classes of the splitter.
_OTHER, _LETTER, _NUMBER, _BLANK, _SPACE, _QUOTE = range(6)
_TAILS = "stmdrvle"  # letters that matter after an apostrophe, classes 6 to 13
_CLASSES = 6 + len(_TAILS)

# Splitter states: what the current pre-token is.
(START, LETTERS, NUMBERS, OTHERS, ONE_BLANK, BLANKS, ONE_SPACE, SPACES,
 QUOTE, QUOTE_R, QUOTE_V, QUOTE_L, DONE) = range(13)
_STATES = 13


def _compile_splitter() -> tuple[np.ndarray, np.ndarray]:
    """(next state, output) by state and class; output bit 0: a pre-token begins at this
    character, bit 1: one begins at the character before."""
    tail = {c: 6 + i for i, c in enumerate(_TAILS)}

    def kind(c: int) -> int:
        return _LETTER if c >= 6 else c

    def begin(c: int) -> int:
        """The state after the first character of a pre-token."""
        return {_LETTER: LETTERS, _NUMBER: NUMBERS, _OTHER: OTHERS, _BLANK: ONE_BLANK, _SPACE: ONE_SPACE, _QUOTE: QUOTE}[kind(c)]

    goes = {LETTERS: _LETTER, NUMBERS: _NUMBER}
    state = np.zeros((_STATES, _CLASSES), np.uint8)
    output = np.zeros((_STATES, _CLASSES), np.uint8)

    def set_(s, c, to, out):
        state[s, c], output[s, c] = to, out

    for c in range(_CLASSES):
        k = kind(c)
        white = k in (_BLANK, _SPACE)
        for s in range(_STATES):
            set_(s, c, begin(c), 1)
        for s, same in goes.items():
            if k == same:
                set_(s, c, s, 0)
        if k in (_OTHER, _QUOTE):
            for s in (OTHERS, QUOTE):
                set_(s, c, OTHERS, 0)
        # a run of white space; the last character of it may belong to what follows
        for s in (ONE_BLANK, BLANKS, ONE_SPACE, SPACES):
            if white:
                set_(s, c, BLANKS if k == _BLANK else SPACES, 0)
            elif s in (ONE_BLANK, BLANKS):  # a blank joins the next pre-token
                to = {_LETTER: LETTERS, _NUMBER: NUMBERS}.get(k, OTHERS)
                set_(s, c, to, 0 if s == ONE_BLANK else 2)
            else:
                set_(s, c, begin(c), 1 if s == ONE_SPACE else 3)
    for letter in "stmd":
        set_(QUOTE, tail[letter], DONE, 0)
    for letter, to in zip("rvl", (QUOTE_R, QUOTE_V, QUOTE_L)):
        set_(QUOTE, tail[letter], to, 0)
    # 're, 've and 'll, or else the apostrophe was alone and a word began after it
    for s, last in ((QUOTE_R, "e"), (QUOTE_V, "e"), (QUOTE_L, "l")):
        for c in range(_CLASSES):
            if kind(c) == _LETTER:
                set_(s, c, LETTERS, 2)
            else:
                set_(s, c, begin(c), 3)
        set_(s, tail[last], DONE, 0)
    return state, output


class Splitter:
    """Pre-token starts of texts given as bytes."""

    CHUNK = 64

    def __init__(self, class_of: np.ndarray):
        self.class_of = class_of
        state, self.output = _compile_splitter()
        hold = np.arange(_STATES, dtype=np.uint8)[:, None]  # the class of padding changes nothing
        self.next = np.concatenate([state, hold], 1).ravel()
        self.out = np.concatenate([self.output, np.zeros((_STATES, 1), np.uint8)], 1).ravel()

    def __call__(self, codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Whether a pre-token begins at each code point; text i is codes[bounds[i]:bounds[i + 1]].

        At the end of a text a delayed mark is left over where the text ends in
        an apostrophe and r, v or l.
        """
        width, pad = _CLASSES + 1, _CLASSES
        lengths = np.diff(bounds)
        per = -(-lengths // self.CHUNK)
        first = np.cumsum(per) - per
        n = int(per.sum())
        text = np.repeat(np.arange(len(lengths)), lengths)
        place = np.arange(len(codes)) - bounds[text] + first[text] * self.CHUNK
        grid = np.full(n * self.CHUNK, pad, np.uint8)
        grid[place] = self.class_of[codes]
        columns = np.ascontiguousarray(grid.reshape(n, self.CHUNK).T).astype(np.int16)
        # every chunk as a map from entry state to exit state
        maps = np.broadcast_to(np.arange(_STATES, dtype=np.int16), (n, _STATES)).copy()
        for c in columns:
            maps = self.next[maps * width + c[:, None]].astype(np.int16)
        # inclusive prefix scan of the maps within each text, by doubling
        nth = np.arange(n) - np.repeat(first, per)
        step = 1
        while step < per.max(initial=0):
            late = np.flatnonzero(nth >= step)
            maps[late] = np.take_along_axis(maps[late], maps[late - step], 1)
            step *= 2
        entry = np.full(n, START, np.int16)
        inner = np.flatnonzero(nth > 0)
        entry[inner] = maps[inner - 1, START]
        marks = np.empty((self.CHUNK, n), np.uint8)
        state = entry
        for j, c in enumerate(columns):
            at = state * width + c
            marks[j] = self.out[at]
            state = self.next[at].astype(np.int16)
        marks = marks.T.ravel()[place]
        begins = (marks & 1).astype(bool)
        before = np.flatnonzero(marks & 2)
        begins[before - 1] = True
        # a text that ends after 'r, 'v or 'l: the letter is a pre-token of its own
        ended = np.flatnonzero(per)
        last = state[first[ended] + per[ended] - 1]
        open_ = ended[(last >= QUOTE_R) & (last <= QUOTE_L)]
        begins[bounds[open_ + 1] - 1] = True
        return begins


class Counter:
    """The counting transducer of a byte-level BPE vocabulary, compiled as it is used."""

    def __init__(self, ranks: dict[tuple[bytes, bytes], int], tokens: list[bytes], max_states: int = 250_000, remember: int = 200_000):
        self.ranks = ranks
        self.is_token = {t: t for t in {t for t in tokens if len(t) == 1} | {a + b for a, b in ranks}}
        self.starts = {t[:i] for t in self.is_token for i in range(1, len(t) + 1)}
        self.fits: dict[tuple[bytes, bytes], bool] = {}
        self.known: dict[bytes, int] = {}
        self.max_states, self.remember = max_states, remember
        self._clear()

    def _clear(self):
        # a state: the suffix, the last token of the encoding that ends at each place of the
        # suffix, and the number of tokens up to each place, relative to the last
        start = (b"", (b"",), (0,))
        self.number = {start: 0}
        self.states = [start]
        self.moves: dict[int, int] = {}  # state << 8 | byte -> next state << 8 | change + 128

    def encode(self, raw: bytes) -> list[bytes]:
        """Plain BPE of a short byte string: the merge of lowest rank first."""
        parts = [raw[i: i + 1] for i in range(len(raw))]
        while len(parts) > 1:
            ranked = [self.ranks.get(p, 1 << 60) for p in zip(parts, parts[1:])]
            low = min(ranked)
            if low == 1 << 60:
                break
            i = ranked.index(low)
            parts[i: i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def adjoin(self, left: bytes, right: bytes) -> bool:
        """Whether BPE leaves these two tokens side by side (no left one: a text's first token)."""
        key = (left, right)
        found = self.fits.get(key)
        if found is None:
            if len(self.fits) >= self.max_states:
                self.fits.clear()
            found = self.fits[key] = self.encode(left + right) == ([left, right] if left else [right])
        return found

    def _compile(self, s: int, byte: int) -> int:
        """The transition from state ``s``: next state << 8 | change in the number of tokens + 128."""
        suffix, lasts, counts = self.states[s]
        grown = suffix + bytes([byte])
        for start in range(len(grown)):
            token = self.is_token.get(grown[start:])
            if token is not None and self.adjoin(lasts[start], token):
                break
        else:
            raise ValueError(f"no token for byte {byte}")
        delta = counts[start] + 1
        cut = next(i for i in range(len(grown) + 1) if grown[i:] in self.starts or i == len(grown))
        state = (grown[cut:], (*lasts, token)[cut:], tuple(c - delta for c in (*counts, delta)[cut:]))
        to = self.number.get(state)
        if to is None:
            to = self.number[state] = len(self.states)
            self.states.append(state)
        move = self.moves[s << 8 | byte] = to << 8 | delta + 128
        return move

    def count(self, piece: bytes) -> int:
        """Number of tokens of one pre-token."""
        n = self.known.get(piece)
        if n is None:
            if len(self.states) > self.max_states:
                self._clear()
            n = s = 0
            moves = self.moves
            for byte in piece:
                move = moves.get(s << 8 | byte) or self._compile(s, byte)
                s = move >> 8
                n += (move & 255) - 128
            if len(self.known) >= self.remember:
                self.known.clear()
            if len(piece) <= 64:
                self.known[piece] = n
        return n


def _byte_letters() -> dict[str, int]:
    """The printable stand-ins of bytes in byte-level vocabularies (fixed by the format)."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class TokenCounter:
    """Exact token counts for a byte-level BPE file of the ``tokenizers`` library."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kind = spec["pre_tokenizer"]
        if spec["model"]["type"] != "BPE" or spec.get("normalizer") or kind["type"] != "ByteLevel" or kind["add_prefix_space"] or not kind["use_regex"]:
            raise ValueError(f"{path} is not a plain byte-level BPE")
        letters = _byte_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.specials = [t["content"] for t in spec["added_tokens"]]
        special = set(self.specials)
        self.counter = Counter({(raw(a), raw(b)): i for i, (a, b) in enumerate(merges)}, [raw(t) for t in spec["model"]["vocab"] if t not in special])
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True)))) if self.specials else None
        class_of = np.zeros(0x110000, np.uint8)
        everything = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        for cls, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\s+")):
            for m in regex.finditer(pattern, everything):
                class_of[[ord(c) for c in m.group()]] = cls
        class_of[ord(" ")], class_of[ord("'")] = _BLANK, _QUOTE
        for i, c in enumerate(_TAILS):
            class_of[ord(c)] = 6 + i
        self.splitter = Splitter(class_of)

    def counts(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each text buf[offsets[i]:offsets[i + 1]] (UTF-8)."""
        n = len(offsets) - 1
        extra = np.zeros(n, np.int64)
        owner = np.arange(n)
        if self.cut is not None:
            data = buf.tobytes()
            if any(s.encode() in data for s in self.specials):  # a special token counts one and parts the text
                texts = [data[a:b].decode("utf-8", "replace") for a, b in zip(offsets, offsets[1:])]
                parts = [self.cut.split(t) for t in texts]
                extra = np.array([len(p) - 1 for p in parts], np.int64)
                owner = np.repeat(owner, [len(p) for p in parts])
                pieces = [x.encode() for p in parts for x in p]
                buf = np.frombuffer(b"".join(pieces), np.uint8)
                offsets = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
        totals = extra.astype(np.float64)
        if len(buf):
            np.add.at(totals, owner, self._plain(buf, np.asarray(offsets, np.int64)))
        return totals.astype(np.int64)

    def _plain(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        heads = (buf & 0xC0) != 0x80
        at = np.flatnonzero(heads)  # byte of each code point
        codes = np.frombuffer(buf.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        bounds = np.searchsorted(at, offsets)
        starts = at[self.splitter(codes, bounds)]
        lengths = np.diff(starts, append=len(buf))
        ends = starts + lengths
        sizes = np.empty(len(starts), np.int64)
        # equal pre-tokens of up to 15 bytes are counted once
        data, count = buf.tobytes(), self.counter.count
        short, low, high = short_keys(buf, starts, lengths)
        first, inverse, odd = group_keys(low, high)
        if len(short):
            found = [count(data[a:b]) for a, b in zip(starts[short[first]].tolist(), ends[short[first]].tolist())]
            sizes[short] = np.array(found, np.int64)[inverse]
        for i in short[odd].tolist():
            sizes[i] = count(data[starts[i]: ends[i]])
        for i in np.flatnonzero(lengths >= 16).tolist():
            sizes[i] = count(data[starts[i]: ends[i]])
        owner = np.searchsorted(offsets, starts, "right") - 1
        return np.bincount(owner, sizes, minlength=len(offsets) - 1)


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 1024, text_col: str = "text", batch_bytes: int = 1 << 20) -> DataFrame:
    """``docs`` with n_bytes (UTF-8), n_tokens and over_limit; NULL counts as empty (0, 0, false).

    Input columns of those names are replaced.  No shuffle; each task compiles the states
    its texts need, in memory that the vocabulary bounds.
    """

    @F.pandas_udf("long")
    def tokens(texts: pd.Series) -> pd.Series:
        counter = per_worker(("token counter", tokenizer_path), lambda: TokenCounter(tokenizer_path))
        buf, offsets = text_bytes(pa.array(texts.tolist(), pa.string()))
        parts = [counter.counts(buf[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a]) for a, b in slices(offsets, batch_bytes)]
        return pd.Series(np.concatenate(parts) if parts else np.zeros(0, np.int64))

    text = F.col(text_col)
    counted = docs.withColumn("__tokens", tokens(text))
    return counted.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("n_bytes", "n_tokens", "over_limit")],
                          F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
                          F.col("__tokens").alias("n_tokens"), (F.col("__tokens") > limit).alias("over_limit"))
