"""BPE encoding by dynamic programming over prefixes, for word vocabularies with an end-of-word mark.

The encoding of a word's prefix ends in exactly one token. Going through a word, an automaton over all
tokens lists those that end at a position; the last token is the one that stands at the word's start or
follows the last token of the prefix before it as a pair that merging would leave alone. Following the
stored tokens back from the word's end gives the ids, the same that merging by rank gives.
"""

from __future__ import annotations

import hashlib
import json
import struct
import unicodedata
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

CACHED_WORDS = 200_000  # words a worker remembers; a full memory starts anew

# fixed value: how the vocabulary's makers cut text into words
_SUFFIX = "</w>"
_LAST = 0x1000  # added to the code of a word's last symbol, so that it is one character of its own


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class WordBpe:
    """A vocabulary file of this kind: ``NFC``, white space dropped, lower case, byte symbols, merges by rank."""

    def __init__(self, file_text: str):
        spec = json.loads(file_text)
        model = spec["model"]
        if model["end_of_word_suffix"] != _SUFFIX or model.get("unk_token") or spec.get("decoder"):
            raise ValueError("not a word vocabulary with end-of-word marks")
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = {i: t for t, i in (self.vocab | self.special).items()}
        self.names = names
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words_in = regex.compile(split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"), regex.V0)
        self.special_in = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self.symbols = byte_symbols()

        self.merged: dict[tuple[int, int], int] = {}  # pair -> token it becomes
        self.rank: dict[int, int] = {}  # token -> rank of the merge that makes it, -1 for single symbols
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank_of_pair: dict[tuple[int, int], int] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            pair = self.vocab[left], self.vocab[right]
            token = self.vocab[left + right]
            self.merged.setdefault(pair, token)
            self.rank_of_pair.setdefault(pair, rank)
            if token not in self.parts:
                self.parts[token], self.rank[token] = pair, rank
        self.fits_memory: dict[tuple[int, int], bool] = {}
        self.ids_memory: dict[str, bytes] = {}
        self.text_memory: dict[str, str] = {}

        spelled = {}
        for name, token in self.vocab.items():
            plain = name.removesuffix(_SUFFIX) if name != _SUFFIX else name
            ended = plain != name
            spelled[plain[:-1] + chr(ord(plain[-1]) + _LAST) if ended else plain] = token
        spelled = {s: token for s, token in spelled.items() if len(s) == 1 or token in self.parts}
        self.automaton = self._automaton(spelled)
        # tokens that merging their own symbols never yields take no part
        reached = {s: token for s, token in spelled.items() if self.encode_symbols(s) == [token]}
        if len(reached) < len(spelled):
            self.automaton = self._automaton(reached)

    @staticmethod
    def _automaton(spelled: dict[str, int]) -> ahocorasick.Automaton:
        made = ahocorasick.Automaton()
        for spelling, token in spelled.items():
            made.add_word(spelling, (len(spelling), token))
        made.make_automaton()
        return made

    def fits(self, left: int, right: int) -> bool:
        """Whether merging keeps the border between these two tokens.

        Undoes the merges of both sides from the latest to the earliest. At each point the two pieces that
        touch at the border must not have been merged before the merge just undone took one of them away;
        among equal ranks the leftmost goes first.
        """
        known = self.fits_memory.get((left, right))
        if known is not None:
            return known
        a, b = left, right
        rank = self.rank
        limit, left_first = 1 << 60, False  # a border merge of a lower rank, or of this rank if it lies further left, wins
        while True:
            across = self.rank_of_pair.get((a, b))
            if across is not None and (across < limit or across == limit and left_first):
                good = False
                break
            ra, rb = rank.get(a, -1), rank.get(b, -1)
            if ra < 0 and rb < 0:
                good = True
                break
            # equal ranks: the left token's merge lies further left and was made first, so the right one is undone first
            if ra > rb:
                limit, left_first, a = ra, False, self.parts[a][1]
            else:
                limit, left_first, b = rb, True, self.parts[b][0]
        if len(self.fits_memory) > 1_000_000:
            self.fits_memory.clear()
        self.fits_memory[left, right] = good
        return good

    def encode_symbols(self, symbols: str) -> list[int]:
        """Ids of one word given as symbols, the last one marked."""
        last: list[tuple[int, int]] = [(0, -1)] * (len(symbols) + 1)  # per prefix: length of its last token, the token
        done = -1
        for end, (size, token) in self.automaton.iter(symbols):
            if end == done:
                continue
            before = last[end + 1 - size][1] if size <= end else None
            if before is None or before >= 0 and self.fits(before, token):
                last[end + 1], done = (size, token), end
        ids, at = [], len(symbols)
        while at:
            size, token = last[at]
            ids.append(token)
            at -= size
        return ids[::-1]

    def encode_word(self, word: str) -> list[int]:
        symbols = "".join(self.symbols[b] for b in word.encode("utf-8", "surrogatepass"))
        return self.encode_symbols(symbols[:-1] + chr(ord(symbols[-1]) + _LAST))

    def words(self, text: str) -> list[str]:
        """Words of a text without special tokens."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # no special form at a word's end
        return self.words_in.findall(text.lower())

    def remember(self, words: set[str]) -> None:
        for word in words:
            ids = self.encode_word(word)
            self.ids_memory[word] = struct.pack(f"<{len(ids)}I", *ids)
            self.text_memory[word] = " ".join(self.names[i] for i in ids)

    def encode(self, text: str | None) -> tuple[bytes, str]:
        """Ids as little-endian unsigned 32-bit integers, and the text they decode to (tokens joined by spaces)."""
        if not text:
            return b"", ""
        ids: list[bytes] = []
        pieces: list[str] = []
        at = 0
        for special in [*self.special_in.finditer(text), None]:
            words = self.words(text[at : special.start() if special else len(text)])
            if missing := {word for word in words if word not in self.ids_memory}:
                if len(self.ids_memory) + len(missing) > CACHED_WORDS:
                    self.ids_memory.clear()
                    self.text_memory.clear()
                    missing = set(words)
                self.remember(missing)
            ids.extend(map(self.ids_memory.__getitem__, words))
            pieces.extend(map(self.text_memory.__getitem__, words))
            if special:
                ids.append(struct.pack("<I", self.special[special[0]]))
                pieces.append(special[0])
                at = special.end()
        return b"".join(ids), " ".join(pieces)


_loaded: dict[str, WordBpe] = {}


def _loaded_once(file_text: str) -> WordBpe:
    key = hashlib.sha256(file_text.encode()).hexdigest()
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = WordBpe(file_text)
    return _loaded[key]


def bpe_digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` per row of ``docs``; ``vocabulary`` is a file's path.

    A null or empty text has no tokens. Special tokens spelled out in a text are those tokens. Nothing is
    cut or padded. Repeated rows and null doc_ids pass row by row, other columns are ignored. One pass without
    a shuffle; the file is read by the driver and travels with the tasks.
    """
    with open(vocabulary, encoding="utf-8") as file:
        file_text = file.read()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded_once(file_text)
        for batch in batches:
            sizes, ids_digests, text_digests = [], [], []
            for text in batch.column("text"):
                ids, decoded = bpe.encode(text.as_py())
                sizes.append(len(ids) // 4)
                ids_digests.append(hashlib.sha256(ids).hexdigest())
                text_digests.append(hashlib.sha256(decoded.encode("utf-8", "surrogatepass")).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(ids_digests, pa.string()), pa.array(text_digests, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(encode, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
