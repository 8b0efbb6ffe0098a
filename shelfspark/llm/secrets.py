"""Secrets in text: three plain patterns, and strings that a primed compressor cannot foretell.

A candidate is a run of at least 16 key characters that stands shortly after a sensitive word. Its novelty is the number of bytes
by which it lengthens the zstandard frame of the text around it, with a dictionary of common identifiers loaded, per character.
Names and paths cost little; random keys cost over half a byte a character. A run without a digit is more often a name, and new
names cost 0.55 to 0.75, so it must cost 0.8. Other copies of the candidate are taken out of the text around it, however many there
are. A novel string is reported wherever the text holds it.
"""

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.common import give_back, id_type, map_rows, ready, texts_of

# The base patterns.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 12, "access": 18, "hex": 16, "novel": 16}

KINDS = ("assign", "access", "hex", "novel")
SENSITIVE = ("passw", "passphrase", "secret", "token", "api_key", "apikey", "api-key", "access_key", "private_key", "credential", "bearer", "authorization")

#: Words of code and configuration that the compressor knows beforehand.
IDENTIFIERS = """
true false null none undefined function return import export class const static public private protected string integer
boolean default example localhost config settings environment production development test user username email account
client server service endpoint request response header content application session cookie database host port name value
key keys id uuid path file directory version release build update created modified https http www com org net io api v1 v2
password passwd passphrase secret token access_token refresh_token client_id client_secret api_key apikey access_key
private_key public_key credential credentials bearer authorization signature certificate sha256 md5 base64 encoding utf-8
january february march april may june july august september october november december monday tuesday wednesday thursday
0123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ
"""

#: Plain prose put before what surrounds a run of letters: short texts alone give the compressor no letter frequencies.
PROSE = """
When the road bends past the old mill, most people slow down without thinking much about why. Years ago a family lived there and
kept geese, and visitors would stop to buy eggs or just to talk over the fence. Nobody quite remembers which of them planted
the long row of poplars, but their shade is welcome in July, and in winter you can see through it as far as the quarry. Six
or seven of the trunks have been marked for felling; jobs like that wait until frost makes the ground hard enough for a cart.
"""


class SecretScanner:
    """``spans(text)``: ``(start, kind number, end)`` in code points, end exclusive, in order."""

    def __init__(self, dictionary: str = IDENTIFIERS, novelty: float = 0.55, letters: float = 0.80, reach: int = 48, around: int = 256, level: int = 3):
        import zstandard

        primed = zstandard.ZstdCompressionDict(dictionary.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.press = zstandard.ZstdCompressor(level=level, dict_data=primed, write_content_size=False)
        self.novelty, self.letters, self.reach, self.around = novelty, letters, reach, around
        self.assign = re.compile(ASSIGN, re.ASCII | re.IGNORECASE)
        # Runs are maximal in both cases, so asking for the length at once finds the same matches.
        self.access = re.compile(rf"AKIA[A-Z0-9]{{{LEAST['access'] - 4},}}")
        self.hex = re.compile(rf"[0-9a-f]{{{LEAST['hex']},}}")
        self.sensitive = re.compile("|".join(SENSITIVE), re.ASCII | re.IGNORECASE)
        self.candidate = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST['novel']},}}")
        self.digit = re.compile(r"[0-9]")

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        low = text.lower()
        found = []
        if "passw" in low or "secret" in low or "token" in low or "api" in low:
            found += [(m.start(), 0, m.end()) for m in self.assign.finditer(text) if len(m[2]) >= LEAST["assign"]]
        if "AKIA" in text:
            found += [(m.start(), 1, m.end()) for m in self.access.finditer(text)]
        found += [(m.start(), 2, m.end()) for m in self.hex.finditer(text)]
        if any(w in low for w in SENSITIVE):
            found += self._novel(text, found)
        return sorted(found)

    def _novel(self, text: str, found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        # Base spans in order, with the furthest end so far: a span before ``end`` reaches past ``start`` if that end does.
        starts, ends, at, new = [], [], 0, []
        for a, _, b in sorted(found):
            starts.append(a)
            ends.append(max(b, ends[-1]) if ends else b)
        free = lambda a, b: not ((before := bisect_left(starts, b)) and ends[before - 1] > a)
        candidates = []
        for word in self.sensitive.finditer(text):
            start = max(at, word.end())
            for m in self.candidate.finditer(text, start, min(len(text), word.end() + self.reach + 512)):
                if m.start() > word.end() + self.reach:
                    break
                # The run may go on beyond the stretch searched.
                at = self._run_end(text, m.end())
                if free(m.start(), at):
                    candidates.append((m.start(), at))
        places: dict[str, list[int]] = {}
        for a, b in candidates:
            places.setdefault(text[a:b], []).append(a)
        # A string is measured at each of its places until it is novel at one.
        novel = {s for s, own in places.items() if any(self._is_novel(text, a, a + len(s)) for a in own)}
        if novel:
            new = [(a, 3, b) for a, b in self._copies(text, novel) if free(a, b)]
        return new

    def _is_novel(self, text: str, start: int, end: int) -> bool:
        if self.digit.search(text, start, end):
            return self.marginal(text, start, end) >= self.novelty
        return self.marginal(text, start, end, PROSE) >= self.letters

    def _copies(self, text: str, novel: set[str]) -> list[tuple[int, int]]:
        """All places of the strings, also inside longer runs; of those that overlap, the first and longest."""
        heads: dict[str, list[str]] = {}
        for s in sorted(novel, key=len, reverse=True):
            heads.setdefault(s[: LEAST["novel"]], []).append(s)
        out, size = [], LEAST["novel"]
        for run in self.candidate.finditer(text):
            at = run.start()
            while at <= run.end() - size:
                s = next((s for s in heads.get(text[at : at + size], ()) if text.startswith(s, at)), None)
                if s:
                    out.append((at, at + len(s)))
                at += len(s) if s else 1
        return out

    def _run_end(self, text: str, end: int) -> int:
        more = re.compile(r"[A-Za-z0-9+/_=-]*").match(text, end)
        return more.end()

    def marginal(self, text: str, start: int, end: int, lead: str = "") -> float:
        """Compressed bytes that ``text[start:end]`` adds to what surrounds it, per character. Its other copies there do not count
        as surroundings: no string hides itself."""
        string, size = text[start:end], end - start
        first, last = max(0, start - self.around), end + self.around
        # By a copy's length more on both sides, so that no part of a copy stays at an edge.
        before, after = (x.replace(string, "\0" * size) for x in (text[max(0, first - size) : start], text[end : last + size]))
        before, after = (x.replace("\0", "") for x in (before[len(before) - (start - first) :], after[: self.around]))
        rest = len(self.press.compress((lead + before + after).encode("utf-8", "replace")))
        return (len(self.press.compress((lead + before + after + string).encode("utf-8", "replace"))) - rest) / size


def find_secrets(docs: DataFrame, **options) -> DataFrame:
    """Per row: ``doc_id`` and ``spans``, an array of (kind, start, end) ordered by start, then kind.

    Null and empty texts have none; every row of ``docs`` gives one row.
    """

    def rows(batches):
        scanner = SecretScanner(**options)
        for b in batches:
            yield {"doc_id": b["doc_id"], "spans": [
                [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in scanner.spans(t)] for t in b["text"]]}

    schema = f"doc_id {id_type(docs)}, spans array<struct<kind:string,start:bigint,end:bigint>>"
    return map_rows(texts_of(docs), rows, schema)


def spans_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(docs: DataFrame, mark: str = "[secret]", **options) -> DataFrame:
    """``docs`` with each secret in ``text`` replaced by ``mark``; overlapping spans go together, null texts stay null."""
    ready(docs.sparkSession)

    @F.arrow_udf("string")
    def clean(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = SecretScanner(**options)
        for texts in parts:
            yield pa.array((t if t is None else without(t, scanner.spans(t), mark) for t in texts.to_pylist()), pa.string())
        give_back()

    return docs.withColumn("text", clean("text"))


def without(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    out, at = [], 0
    for start, _, end in spans:
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], mark]
        at = end
    return "".join([*out, text[at:]])
