"""BPE encoding and decoding by dynamic programming over the prefixes of a word.

For every prefix of a word the last token of its encoding is unique. An
automaton over the vocabulary finds the tokens that end at each position; the
one whose predecessor is the stored last token of the shorter prefix and forms
a stable pair with it is stored. Back-pointers give the ids. A pair is stable
if merging its symbols by rank gives back just the pair; pairs are remembered.

Texts are normalised, cut at added tokens and split into words as the
vocabulary file says (NFC, white space, per-letter lower case, word pattern,
byte alphabet, word-end suffix). Null texts encode like empty ones: no ids.
Repeated rows, ties and extra columns of any name pass through untouched.
"""

from __future__ import annotations

import json
import sys
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tickflow.llm.common import small_arrow_batches
from tickflow.llm.stretches import StretchIds, text_batches

#: Unicode white space, and the words of the file's split pattern.
SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
_SPACES = regex.compile(f"[{SPACE}]+")
#: Lower case of letters that are newer than Python's tables.
NEWER_LOWER = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
NEWER_LOWER |= {0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5}
NEWER_LOWER |= {c: c + 0x20 for c in range(0x10D50, 0x10D66)} | {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}
_NEWER = regex.compile("[" + "".join(map(chr, NEWER_LOWER)) + "]")
#: Closes a word, as a letter after the 256 bytes.
_END = 256
_ASKED_BITS = 18
#: Letters of words that are worked on together.
_LETTERS = 1 << 20


def byte_alphabet() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 as itself, the others from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def newer_letters() -> str:
    """Letters and digits of the pattern library's Unicode tables that the tokenizers library's do not have, as a character class."""
    from tokenizers import Regex, pre_tokenizers

    points = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c) == "Cn")
    mine = set("".join(regex.findall(r"[\p{L}\p{N}]+", points)))
    split = pre_tokenizers.Split(Regex(r"[\p{L}\p{N}]+"), "removed", invert=True)
    mine.difference_update(*(piece for piece, _ in split.pre_tokenize_str(points)))
    return "".join(f"{run[0]}-{run[-1]}" for run in _ranges("".join(sorted(mine))) if run)


def _ranges(letters: str) -> list[str]:
    points = np.array([ord(c) for c in letters])
    return ["".join(map(chr, part)) for part in np.split(points, np.flatnonzero(np.diff(points) != 1) + 1)]


class Bpe(StretchIds):
    """One vocabulary; ``newer`` is ``newer_letters()``; ``whole`` says which tokens their own text is encoded as (found out if not given)."""

    def __init__(self, spec: str, newer: str, whole: np.ndarray | None = None, remembered: int = 50_000):
        super().__init__(remembered)
        file = json.loads(spec)
        model = file["model"]
        self.suffix = model["end_of_word_suffix"]
        self.rank = {tuple(m) if isinstance(m, list) else tuple(m.split(" ")): i for i, m in enumerate(model["merges"])}
        self.added = {t["content"]: t["id"] for t in file["added_tokens"]}
        pattern = file["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        # ``newer`` are no letters or digits to the tokenizers library.
        newer = newer or "\0"
        pattern = pattern.replace(r"\s", SPACE).replace(r"[\p{L}]", rf"[\p{{L}}--[{newer}]]").replace(r"[\p{N}]", rf"[\p{{N}}--[{newer}]]")
        pattern = pattern.replace(rf"[^{SPACE}\p{{L}}\p{{N}}]", rf"[^{SPACE}[\p{{L}}\p{{N}}--[{newer}]]]")
        self.pattern = regex.compile(pattern, regex.V1)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")")

        tokens = [*model["vocab"]]
        self.ids = np.array([*model["vocab"].values()], np.uint32)
        number = {t: n for n, t in enumerate(tokens)}
        # The merge that makes a token, the two tokens it joins, and the merges by pair.
        self.made = np.full(len(tokens), -1, np.int32)
        self.left, self.right = np.zeros((2, len(tokens)), np.int32)
        pairs = np.empty((3, len(self.rank)), np.int64)
        for (left, right), rank in self.rank.items():
            joined = number[left + right]
            pairs[:, rank] = number[left], number[right], rank
            if self.made[joined] < 0:
                self.made[joined], self.left[joined], self.right[joined] = rank, number[left], number[right]
        order = np.argsort(pairs[0] << 20 | pairs[1])
        self.pair_keys, self.pair_ranks = (pairs[0] << 20 | pairs[1])[order], pairs[2][order].astype(np.int32)
        # Answers about pairs, each in the one place its hash gives; a place is taken over by the next pair.
        self.asked, self.answered = np.full(1 << _ASKED_BITS, -1, np.int64), np.zeros(1 << _ASKED_BITS, bool)

        byte_of = {letter: i for i, letter in enumerate(byte_alphabet())}
        ends = [t.endswith(self.suffix) for t in tokens]
        texts = [t.removesuffix(self.suffix) if end else t for t, end in zip(tokens, ends)]
        if whole is None:
            whole = np.array([self._merged([*t[:-1], t[-1] + self.suffix] if end else [*t]) == [token] for token, t, end in zip(tokens, texts, ends)])
        self.whole = whole
        self._automaton([(n, [*map(byte_of.__getitem__, t)] + [_END] * end) for n, (t, end) in enumerate(zip(texts, ends)) if whole[n]])

    def _automaton(self, tokens: list[tuple[int, list[int]]]) -> None:
        """States are prefixes of tokens, with links to their longest suffix that is one. Most states go on with one letter only
        (``only``, ``one``); the others have a row in ``many``, where -1 is no way on. ``longest`` is the longest token that ends
        in a state, ``shorter`` the next one that ends a token."""
        self.size = np.zeros(len(self.ids), np.int32)
        goes: dict[int, int] = {}
        own = [-1]
        for n, key in tokens:
            self.size[n] = len(key)
            state = 0
            for letter in key:
                state = goes.setdefault(state << 9 | letter, len(own))
                if state == len(own):
                    own.append(-1)
            own[state] = n
        own = np.array(own, np.int32)
        keys = np.fromiter(goes.keys(), np.int64, len(goes))
        order = np.argsort(keys)
        begin, letter = (keys[order] >> 9).astype(np.int32), (keys[order] & 511).astype(np.int16)
        end = np.fromiter(goes.values(), np.int32, len(goes))[order]
        count = np.bincount(begin, minlength=len(own))
        self.only, self.one = np.full(len(own), -1, np.int16), np.zeros(len(own), np.int32)
        single = count[begin] == 1
        self.only[begin[single]], self.one[begin[single]] = letter[single], end[single]
        wide = count > 1
        wide[0] = True
        # Row 0 is for states without a row; it leads nowhere.
        self.row = np.where(wide, np.cumsum(wide), 0).astype(np.int32)
        self.many = np.full((wide.sum() + 1, _END + 1), -1, np.int32)
        self.many[self.row[0]] = 0  # from the start there is always a way, if only back to it
        self.many[self.row[begin[~single]], letter[~single]] = end[~single]
        self.link = np.zeros(len(own), np.int32)
        self.longest, self.shorter = own.copy(), np.full(len(self.ids), -1, np.int32)
        level = np.array([0])
        while len(level):
            ending = level[own[level] >= 0]
            self.shorter[own[ending]] = self.longest[self.link[ending]]
            others = level[own[level] < 0]
            self.longest[others] = self.longest[self.link[others]]
            first, last = np.searchsorted(begin, level, "left"), np.searchsorted(begin, level, "right")
            here = np.repeat(first - np.cumsum(last - first) + (last - first), last - first) + np.arange((last - first).sum())
            inner = here[begin[here] > 0]
            self.link[end[inner]] = self._go(self.link[begin[inner]], letter[inner])
            level = np.sort(end[here])

    def _child(self, state: np.ndarray, letter: np.ndarray) -> np.ndarray:
        return np.where(self.only[state] == letter, self.one[state], self.many[self.row[state], letter])

    def _go(self, state: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """The longest prefixes of a token that end after one more letter."""
        out = self._child(state, letter)
        todo = np.flatnonzero(out < 0)
        state, letter = state[todo], letter[todo]
        while len(todo):
            state = self.link[state]
            then = self._child(state, letter)
            out[todo] = then
            still = then < 0
            todo, state, letter = todo[still], state[still], letter[still]
        return out

    def _merged(self, symbols: list[str]) -> list[str]:
        """``symbols`` merged by rank, lowest first, leftmost first."""
        while len(symbols) > 1:
            ranked = [(self.rank.get(p, 1 << 30), i) for i, p in enumerate(zip(symbols, symbols[1:]))]
            best = min(ranked)[0]
            if best == 1 << 30:
                break
            out, i = [], 0
            while i < len(symbols):
                if i + 1 < len(symbols) and ranked[i][0] == best:
                    out.append(symbols[i] + symbols[i + 1])
                    i += 2
                else:
                    out.append(symbols[i])
                    i += 1
            symbols = out
        return symbols

    def _stable(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the joint text of two tokens is encoded as just these two, for many pairs."""
        pair = left.astype(np.int64) << 20 | right
        place = (pair * 0x9E3779B97F4A7C1 & (1 << 62) - 1) >> 62 - _ASKED_BITS
        out = self.answered[place]
        new = np.flatnonzero(self.asked[place] != pair)
        if len(new):
            out[new] = self._look(left[new], right[new])
            # Where two new pairs meet in a place, the same one must win in both arrays.
            last = np.full(1 << _ASKED_BITS, -1, np.int32) if len(new) > 1 << 16 else {}
            if isinstance(last, dict):
                new = new[np.unique(place[new], return_index=True)[1]]
            else:
                last[place[new]] = new
                new = last[last >= 0]
            self.asked[place[new]], self.answered[place[new]] = pair[new], out[new]
        return out

    def _look(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Goes back in time along the border: of the two pieces that touch there, the one made last is undone.

        The border was crossed if the touching pieces merge before either was used up.
        """
        out = np.ones(len(left), bool)
        at = np.arange(len(left))
        left_used = right_used = np.full(len(left), 1 << 30)
        while len(at):
            pair = left.astype(np.int64) << 20 | right
            k = np.minimum(np.searchsorted(self.pair_keys, pair), len(self.pair_keys) - 1)
            merge = np.where(self.pair_keys[k] == pair, self.pair_ranks[k], 1 << 30)
            crossed = (merge < left_used) & (merge <= right_used)
            out[at[crossed]] = False
            a, b = self.made[left], self.made[right]
            back_left = a > b
            going = ~crossed & (back_left | (b >= 0))
            left_used, right_used = np.where(back_left, a, left_used)[going], np.where(back_left, right_used, b)[going]
            left, right = np.where(back_left, self.right[left], left)[going], np.where(back_left, right, self.left[right])[going]
            at = at[going]
        return out

    def words(self, words: list[bytes]) -> list[bytes]:
        """Ids (32 bits each) of words in UTF-8."""
        out: list[bytes] = [b""] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(-sizes, kind="stable")
        start = 0
        while start < len(words):
            # Words of like length together, within a bounded number of letters.
            end = start + max(1, int(_LETTERS // (sizes[order[start]] + 2)))
            some = order[start:end]
            ids, ends = self._words([words[i] for i in some], sizes[some])
            data = ids.tobytes()
            for i, first, last in zip(some.tolist(), [0, *(4 * ends).tolist()], (4 * ends).tolist()):
                out[i] = data[first:last]
            start = end
        return out

    def _words(self, words: list[bytes], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, and where those of each end. The longest word is the first. All words go on by one letter at a time."""
        n, longest = len(words), int(sizes[0])
        letters = np.full((longest + 1, n), _END, np.int16)
        flat = np.frombuffer(b"".join(words), np.uint8)
        column = np.repeat(np.arange(n), sizes)
        letters[np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes), column] = flat
        last = np.full((longest + 2, n), -1, np.int32)
        state = np.zeros(n, np.int32)
        # How many words have a letter, or their end, at each place.
        open_ = np.searchsorted(-sizes, -np.arange(longest + 1), "right")
        for place in range(1, longest + 2):
            k = int(open_[place - 1])
            state = self._go(state[:k], letters[place - 1, :k])
            token = self.longest[state]
            # The longest match is right most of the time.
            todo = np.flatnonzero(self.size[token] < place)
            while len(todo):
                asked = token[todo]
                wrong = ~self._stable(last[place - self.size[asked], todo], asked)
                todo = todo[wrong]
                token[todo] = self.shorter[token[todo]]
                todo = todo[self.size[token[todo]] < place]
            last[place, :k] = token
        found, words_of, end = [], [], sizes + 1
        at = np.arange(n)
        while len(at):
            token = last[end[at], at]
            found.append(token)
            words_of.append(at)
            end[at] -= self.size[token]
            at = at[end[at] > 0]
        counts = np.bincount(np.concatenate(words_of), minlength=n)
        ends = np.cumsum(counts)
        ids = np.empty(ends[-1], np.uint32)
        for back, (token, at) in enumerate(zip(found, words_of)):
            ids[ends[at] - 1 - back] = self.ids[token]
        return ids, ends

    def _parts(self, chunk: str) -> list[str | int]:
        """Normalised words, and ids of added tokens, of a stretch that is not printable ASCII."""
        out: list[str | int] = []
        for part in self.cut.split(chunk) if "<|" in chunk else (chunk,):
            if part in self.added:
                out.append(self.added[part])
                continue
            # One letter at a time: the final form of sigma is not used.
            if not part.isascii():
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
                if _NEWER.search(part):
                    part = part.translate(NEWER_LOWER)
            part = part.lower()
            for piece in _SPACES.split(part):
                out.extend(self.pattern.findall(piece))
        return out

    def new(self, chunks: list[str]) -> list[bytes]:
        known, words_of = self.known, self.words_of
        number: dict[str, int] = {}
        out: list = []
        for chunk in chunks:
            words = words_of(chunk)
            if words is None:
                words = self._parts(chunk)
            if len(words) == 1 and not isinstance(words[0], int):
                out.append(number.setdefault(words[0], len(number)))
            else:
                # A word is a stretch too, so it may be known.
                out.append([np.uint32(w).tobytes() if isinstance(w, int) else known.get(w) or number.setdefault(w, len(number)) for w in words])
        ids = self.words([w.encode() for w in number])
        return [ids[p] if isinstance(p, int) else b"".join([ids[x] if isinstance(x, int) else x for x in p]) for p in out]

    def encode_texts(self, texts: pa.Array) -> pa.ListArray:
        """Ids of each text."""
        ids, ends = self.encode(texts)
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.view(np.int32)))


def pieces_of(spec: str) -> pa.Array:
    """The text of each id; null for numbers that are none."""
    file = json.loads(spec)
    named = file["model"]["vocab"] | {t["content"]: t["id"] for t in file["added_tokens"]}
    pieces = [None] * (max(named.values(), default=-1) + 1)
    for token, i in named.items():
        pieces[i] = token
    return pa.array(pieces, pa.string())


def decode(lists: pa.ListArray, pieces: pa.Array) -> pa.Array:
    """The tokens of the ids with a space between two; unknown ids have none. Empty for null."""
    ids = lists.flatten()
    known = pc.and_kleene(pc.greater_equal(ids, 0), pc.less(ids, len(pieces)))
    tokens = pieces.take(pc.if_else(pc.fill_null(known, False), ids, None))
    ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    if tokens.null_count:
        kept = tokens.is_valid().to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(kept)])[ends]
        tokens = tokens.drop_null()
    parted = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), tokens)
    return pc.fill_null(pc.binary_join(parted, " "), "")


_LOADED: dict[int, Bpe] = {}


class Tokenizer:
    """Spark columns over one vocabulary file. The file (fixed size) is read on the driver and broadcast."""

    def __init__(self, spark: SparkSession, path: str):
        small_arrow_batches(spark)
        with open(path, encoding="utf-8") as file:
            spec = file.read()
        newer = newer_letters()
        self._spec = spark.sparkContext.broadcast((spec, newer, Bpe(spec, newer).whole))
        self._pieces = spark.sparkContext.broadcast(pieces_of(spec))

    def encode(self, text: Column | str) -> Column:
        """array<int> of the ids of a text; empty for null."""
        model = _loader(self._spec)

        @F.arrow_udf("array<int>")
        def ids(texts: pa.Array) -> pa.Array:
            bpe = model()
            parts = [bpe.encode_texts(b.column("text")) for b in text_batches([pa.RecordBatch.from_arrays([texts], ["text"])])]
            return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

        return ids(text)

    def decode(self, ids: Column | str) -> Column:
        """Text of an array of ids; empty for null."""
        pieces = self._pieces

        @F.arrow_udf("string")
        def text(lists: pa.Array) -> pa.Array:
            return decode(lists, pieces.value)

        return text(ids)


def _loader(spec):
    def model() -> Bpe:
        key = hash(spec.value[0])
        if key not in _LOADED:
            _LOADED.clear()
            _LOADED[key] = Bpe(*spec.value)
        return _LOADED[key]

    return model
