"""Token ids of whole texts, encoded word by word where the tokenizer allows it."""

from __future__ import annotations

import json
import string
import sys
from array import array
from collections.abc import Iterable
from types import ModuleType

#: ASCII capitals to small letters, on UTF-8 bytes.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
MARKS = string.punctuation.encode()


def latin(word: bytes) -> bool:
    """Whether ``word`` is of letters below U+0250, without the one capital that turns into a letter and a mark."""
    text = word.decode("utf-8")
    return text.isalpha() and max(text) < "\u0250" and "\u0130" not in text


class WordEncoder:
    """Ids of texts as the ``tokenizers`` library gives them, without added special tokens.

    A tokenizer whose pre-tokenizer throws white space away never lets a match span white space, so the ids of a text
    are those of its pieces between ASCII white space in a row. The library encodes each distinct piece once; a piece
    that is a word with ASCII marks behind it is put together from both, and a word of Latin letters goes straight to the library's
    merges, since nothing before them changes or cuts it. The memo is emptied of all but the latest when it holds ``limit``
    pieces and never keeps long ones: that bounds memory and changes no result. Any other tokenizer encodes texts whole.
    """

    def __init__(self, path: str, limit: int = 400_000, longest: int = 64):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        suffix = word_end(path)
        self.by_piece = suffix is not None
        self.limit, self.longest = limit, longest
        self.memo: dict[bytes, bytes] = {}
        if self.by_piece:
            # Bytes as the characters that the library's merges know them by; those left out are the same.
            same = {*range(33, 127), *range(161, 173), *range(174, 256)}
            self.shown = {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in same)}
            self.marks: dict[bytes, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        if not self.by_piece:
            return self._library(texts)
        memo = self.memo
        raw = [t.encode("utf-8", "replace") for t in texts]
        # Only strings of special tokens, which hold this mark, depend on the case of ASCII letters.
        pieces = [(t if b"<|" in t else t.translate(LOWER)).split() for t in raw]
        met = set().union(*pieces)
        new = met.difference(memo)
        self._learn(new)
        out = [b"".join(map(memo.__getitem__, p)) for p in pieces]
        for w in new:
            if len(w) > self.longest:
                del memo[w]
        if len(memo) > self.limit:
            # The latest pieces stay, if they are few enough: the frequent ones are among them.
            last = {w: memo[w] for w in met if w in memo} if 2 * len(met) < self.limit else {}
            memo.clear()
            memo.update(last)
        return out

    def _learn(self, new: set[bytes]) -> None:
        words, rest, ended = set(), [], []
        for w in new:
            stem = w.rstrip(MARKS)
            if stem.isalpha() or latin(stem):
                words.add(stem)
                if len(stem) < len(w):
                    ended.append((w, stem))
            else:
                rest.append(w)
        memo = self.memo
        memo.update(zip(rest, self._library([w.decode("utf-8") for w in rest]), strict=True))
        # Stems that were only met with a mark may be long as well; they are not kept.
        passing = [w for w in words if len(w) > self.longest and w not in new]
        words.difference_update(memo)
        self._words(words)
        # A row of marks up to the end of a piece is one match, whatever its marks are.
        if len(self.marks) > 10_000:
            self.marks.clear()
        unknown = list({w[len(stem):] for w, stem in ended}.difference(self.marks))
        self.marks.update(zip(unknown, self._library([tail.decode() for tail in unknown]), strict=True))
        for w, stem in ended:
            memo[w] = memo[stem] + self.marks[w[len(stem):]]
        for w in passing:
            del memo[w]

    def _words(self, words: Iterable[bytes]) -> None:
        """Learn words of Latin letters: such a word is one match of the pre-tokenizer, and only its case may change before."""
        merged, shown, memo = self.tokenizer.model.tokenize, self.shown, self.memo
        for w in words:
            low = w.lower().decode() if w.isascii() else w.decode("utf-8").lower().encode().decode("latin-1").translate(shown)
            memo[w] = array("I", [t.id for t in merged(low)]).tobytes()

    def _library(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def worker_encoder(path: str) -> WordEncoder:
    """The encoder of this Python worker: the tasks it runs one after another share the memo.

    Functions reach workers by value, so their module's globals last for one task only; a module of the worker's own lasts.
    """
    kept = sys.modules.setdefault("shelfspark_worker", ModuleType("shelfspark_worker"))
    if getattr(kept, "path", None) != path:
        kept.path, kept.encoder = path, WordEncoder(path)
    return kept.encoder


def word_end(path: str) -> str | None:
    """The end-of-word mark of a tokenizer that removes white space before it merges, as ``word_bpe_49k.json`` does."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    split = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
    normal = {n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])}
    added = spec.get("added_tokens") or []
    fits = (
        split.get("type") == "Split" and split.get("behavior") == "Removed" and split.get("invert") is True
        and r"[\p{L}]+" in split["pattern"].get("Regex", "") and r"[^\s\p{L}\p{N}]+" in split["pattern"]["Regex"]
        and "Lowercase" in normal and normal <= {"NFC", "Replace", "Lowercase"}
        and all(t["content"].startswith("<|") and not (t["lstrip"] or t["rstrip"] or t["single_word"]) for t in added)
    )
    return spec["model"].get("end_of_word_suffix") if fits else None
