"""Token counts by a compiled finite-state transducer.

The tokenizer (byte-level BPE with word ends) is compiled to a deterministic transducer over characters; each transition
carries the number of tokens that it emits. It is built from one fact about BPE: a sequence of tokens is the encoding of
its string exactly if every two neighbours are the encoding of their own two. So the last token after each character is
the one token that ends there and agrees with the last token before it, and what can matter later of what has been
read is little: the ends of it that begin some token, and for each of them the last token before it and how many tokens
ago that was. That is the state. Its ends are no longer than the longest token, so there are finitely many states, and a
word of any length walks among them. They are made when first reached and forgotten when there are too many; a
state is a value, so it outlives the table. A second, closing transition stands for the last character of a word.

The lexer that finds words is a part of the automaton: its states are between words, in letters, in symbols, and after an
apostrophe that may begin an ending, with the state within the word and the character that waits to know if it is the last.

A text is cut into chunks. A chunk maps the state before it to the state after it and a count. A blank leads to the
state between words from wherever one comes, so the map of a chunk with a blank is a count, a state, and the head before
its first blank, whose count alone depends on the state before; a chunk without one maps state by state. Maps compose by a
scan by doubling, and each character is read once.

Defined results: a null text counts as empty, with 0 tokens; rows repeat as given; extra columns, clashing ones too, are
ignored; a text of any length, in words of any length, takes bounded memory besides itself; an empty table gives an empty
table.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from pathlib import Path

import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .bpe import byte_letters
from .common import arrow_map, ids_and_texts, only

#: Characters of a chunk; states, transitions, pairs of tokens and words that a worker remembers at most.
CHUNK, STATES, EDGES, PAIRS, WORDS = 1 << 14, 250_000, 600_000, 400_000, 1_000_000
#: The pattern of the words of this kind of vocabulary, and the endings it takes apart.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ENDINGS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")

#: What matters of a word so far, the longest first: an end of it that begins a token, the last token before that end, and the
#: tokens since then.
Ends = tuple[tuple[str, str | None, int], ...]
START: Ends = (("", None, 0),)


# Capital letters of Unicode 16, which Python's tables may lack, with their small letters; the last is a range.
_NEWER = {0x1C89: 0x1C8A, 0xA7CB: 0x0264, 0xA7CC: 0xA7CD, 0xA7DA: 0xA7DB, 0xA7DC: 0x019B} | {c: c + 0x20 for c in range(0x10D50, 0x10D66)}


class Transducer:
    """Over the byte letters of a word. States are numbers here; ends() gives their value."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], end: str):
        self.rank = {tuple(m): i for i, m in enumerate(merges)}
        #: For each token that a merge makes: its two parts and the merge's rank.
        self.made = {a + b: (a, b, i) for (a, b), i in self.rank.items()}
        if len(self.made) < len(self.rank):
            raise ValueError("two merges make one token")
        self.vocab, self.end = vocab, end
        bodies = {t.removesuffix(end) if len(t) > len(end) else t for t in vocab}
        self.begins = {b[:i] for b in bodies for i in range(len(b))}
        self.agree: dict[tuple, bool] = {}
        self.reset()

    def reset(self) -> None:
        self.values: list[Ends] = [START]
        self.number: dict[Ends, int] = {START: 0}
        #: (state, letter) under one number -> (state, tokens); for closing transitions the tokens alone.
        self.next: dict[int, tuple[int, int]] = {}
        self.close: dict[int, int] = {}

    def ends(self, state: int) -> Ends:
        return self.values[state]

    def state(self, ends: Ends) -> int:
        found = self.number.get(ends)
        if found is None:
            if len(self.values) >= STATES:
                self.reset()
            found = self.number[ends] = len(self.values)
            self.values.append(ends)
        return found

    def _apart(self, left: str, right: str) -> bool:
        """Two tokens side by side: does no merge run across their border before the pieces there go into larger ones?

        Told from the end: of the two pieces at the border the one made last is taken apart, and the pair that stood
        there before must not merge sooner than it was made. Of equal ranks the leftmost merge comes first.
        """
        last, at_once = 1 << 60, False
        while True:
            rank = self.rank.get((left, right), 1 << 60)
            if rank < last or (at_once and rank == last):
                return False
            a, b = self.made.get(left), self.made.get(right)
            if a is None and b is None:
                return True
            if b is None or (a is not None and a[2] > b[2]):
                left, last, at_once = a[1], a[2], False
            else:
                right, last, at_once = b[0], b[2], True

    def _whole(self, token: str) -> bool:
        """Is the token the encoding of its own string?"""
        known = self.agree.get((None, token))
        if known is None:
            a, b, rank = self.made.get(token, (None, None, 0))
            if a is None:
                known = True
            else:  # its parts must stand side by side up to the merge that makes it
                known = self._whole(a) and self._whole(b)
                if known:
                    first = self.rank.pop((a, b))
                    known = self._apart(a, b)
                    self.rank[a, b] = first
            self.agree[None, token] = known
        return known

    def _fits(self, last: str | None, token: str) -> bool:
        if last is None:
            return self._whole(token)
        known = self.agree.get((last, token))
        if known is None:
            if len(self.agree) > PAIRS:
                self.agree.clear()
            known = self.agree[last, token] = self._whole(token) and self._apart(last, token)
        return known

    def step(self, state: int, letter: str) -> tuple[int, int]:
        """(state, tokens more than before, which may be fewer) after a letter that is not the last."""
        edge = state << 10 | ord(letter)  # byte letters are below 512
        found = self.next.get(edge)
        if found is None:
            token, after = None, []
            for end, last, n in self.values[state]:
                longer = end + letter
                if token is None and longer in self.vocab and self._fits(last, longer):
                    token, since = longer, n
                if longer in self.begins:
                    after.append((longer, last, n))
            if token is None:
                raise ValueError(f"no token ends with {letter!r}")
            more = 1 - since
            after = [(end, last, n + more) for end, last, n in after] if more else after
            tables = self.next
            found = self.state((*after, ("", token, 0))), more
            if len(self.next) > EDGES:
                self.next.clear()
            if tables is self.next:  # else the state is of a table that is gone
                tables[edge] = found
        return found

    def last(self, state: int, letter: str) -> int:
        """Tokens more than before after the last letter of a word."""
        edge = state << 10 | ord(letter)
        found = self.close.get(edge)
        if found is None:
            if len(self.close) > EDGES:
                self.close.clear()
            for end, last, n in self.values[state]:
                token = end + letter + self.end
                if token in self.vocab and self._fits(last, token):
                    found = self.close[edge] = 1 - n
                    break
            else:
                raise ValueError(f"no token ends with {letter!r}")
        return found

    def count(self, word: str) -> int:
        """Tokens of one word (byte letters, not empty): the sum of what its transitions carry."""
        state = total = 0
        known = self.next
        for letter in word[:-1]:
            step = known.get(state << 10 | ord(letter))
            if step is None:
                step = self.step(state, letter)
                known = self.next
            state, more = step
            total += more
        return total + self.last(state, word[-1])


#: State of the automaton over characters: the lexer's mode, the ends of the word before the waiting character(s), and these.
State = tuple[str, Ends, str]
BETWEEN: State = ("", START, "")
#: (heads before the first blank, count from there on or None without a blank, state after it)
Map = tuple[tuple[str, ...], int | None, State]


class Counter:
    """Counts the tokens of texts as the library does for a file of byte-level BPE with word ends."""

    def __init__(self, spec: dict):
        model = spec["model"]
        if model["type"] != "BPE" or not model["end_of_word_suffix"] or spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] != PATTERN:
            raise ValueError("a BPE model with word ends and the pattern of this module is asked for")
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.fst = Transducer(model["vocab"], merges, model["end_of_word_suffix"])
        self.words = regex.compile(PATTERN).findall
        self.special = regex.compile("|".join(regex.escape(t["content"]) for t in spec["added_tokens"]) or r"(?!)")
        self.mark = [t["content"][:2] for t in spec["added_tokens"]]
        self.letters = dict(enumerate(byte_letters()))
        self.known: dict[str, int] = {}
        self.kinds: dict[str, str] = {}

    def _spelt(self, text: str) -> str:
        return text.encode().decode("latin-1").translate(self.letters)

    def word(self, word: str) -> int:
        n = self.known.get(word)
        if n is None:
            n = self.fst.count(self._spelt(word))
            if len(self.known) > WORDS:
                self.known.clear()
            if len(word) <= 64:
                self.known[word] = n
        return n

    def between_words(self, text: str) -> int:
        """Tokens of text that starts and ends between words: the transitions of a known word are remembered as one."""
        words = self.words(text)
        found = list(map(self.known.get, words))
        return sum(found) if None not in found else sum(self.word(w) if n is None else n for n, w in zip(found, words))

    def _kind(self, char: str) -> str:
        kind = self.kinds.get(char)
        if kind is None:
            kind = self.kinds[char] = "S" if regex.match(r"\s", char) else "L" if regex.match(r"\p{L}", char) else "N" if regex.match(r"\p{N}", char) else "O"
        return kind

    def run(self, state: State, text: str) -> tuple[State, int]:
        """The automaton: the state after text and the tokens that it emits (what waits in a state is counted later)."""
        mode, ends, held = state
        at, total = self.fst.state(ends), 0
        for char in text:
            kind = self._kind(char)
            if mode == "'":  # held: an apostrophe that begins a word, perhaps a letter after it
                if held + char in ENDINGS:
                    total += self.word(held + char)
                    mode, held = "", ""
                    continue
                if len(held) == 1 and any(e.startswith(held + char) for e in ENDINGS):
                    held += char
                    continue
                if len(held) == 1 and kind == "O":
                    mode = "O"
                else:  # the apostrophe stands alone
                    total += self.word("'")
                    mode, held = ("L", held[1]) if len(held) > 1 else ("", "")
            if mode and mode == kind:
                for letter in self._spelt(held):
                    at, more = self.fst.step(at, letter)
                    total += more
                held = char
                continue
            if mode:
                total += self._closed(at, held)
            at, mode, held = 0, "", ""
            if kind == "N":
                total += self.word(char)
            elif kind != "S":
                mode, held = "'" if char == "'" else kind, char
        return (mode, self.fst.ends(at), held), total

    def _closed(self, at: int, held: str) -> int:
        *letters, last = self._spelt(held)
        total = 0
        for letter in letters:
            at, more = self.fst.step(at, letter)
            total += more
        return total + self.fst.last(at, last)

    def closed(self, state: State) -> int:
        """Tokens that the end of the text emits."""
        mode, ends, held = state
        if mode == "'":
            return self.word("'") + (self.word(held[1]) if len(held) > 1 else 0)
        return self._closed(self.fst.state(ends), held) if mode else 0

    def chunk_map(self, chunk: str, first: bool = False) -> Map:
        """first: the chunk starts between words."""
        a, b = 0 if first else chunk.find(" ") + 1, chunk.rfind(" ") + 1
        if not a and not first:
            return (chunk,), None, BETWEEN
        after, n = self.run(BETWEEN, chunk[max(a, b) :])
        return ((chunk[:a],) if a else ()), self.between_words(chunk[a:b]) + n, after

    def compose(self, a: Map, b: Map) -> Map:
        if a[1] is None:
            return a[0] + b[0], b[1], b[2]
        state, n = self.walk(a[2], b[0])
        return a[0], a[1] + n + (b[1] or 0), state if b[1] is None else b[2]

    def walk(self, state: State, heads: tuple[str, ...]) -> tuple[State, int]:
        total = 0
        for head in heads:
            state, n = self.run(state, head)
            total += n
        return state, total

    def _plain(self, text: str) -> int:
        """Tokens of text without special tokens."""
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        text = text.translate(_NEWER).replace("Σ", "σ").lower()  # letter by letter: no final sigma
        maps = [self.chunk_map(text[i : i + CHUNK], i == 0) for i in range(0, len(text), CHUNK)]
        while len(maps) > 1:  # a scan by doubling; only its last value is needed
            maps = [self.compose(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        return maps[0][1] + self.closed(maps[0][2]) if maps else 0  # the first chunk's map has a count

    def count(self, text: str) -> int:
        if any(m in text for m in self.mark):
            parts = self.special.split(text)
            return len(parts) - 1 + sum(map(self._plain, parts))
        return self._plain(text)


_READY: dict[str, Counter] = {}


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 2048, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) for each row of docs; one pass, no shuffle."""
    spark = docs.sparkSession
    docs = only(docs, key, text)
    data = Path(tokenizer).read_bytes()
    name = hashlib.sha256(data).hexdigest()
    shared = spark.sparkContext.broadcast(data)  # the vocabulary's file, under 2 MB

    def run(b):
        if name not in _READY:
            _READY.clear()
            _READY[name] = Counter(json.loads(shared.value))
        counter = _READY[name]
        keys, texts = ids_and_texts(b, key, text)
        n = [counter.count(t) for t in texts]
        yield {key: keys, "n_bytes": [len(t.encode()) for t in texts], "n_tokens": n, "over_limit": [x > limit for x in n]}

    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])
    return arrow_map(docs, run, schema)
