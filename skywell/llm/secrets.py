"""Secrets in texts, and in what the texts encode.

A worklist of layers starts with the text itself. Each layer is searched for secrets and then
unwrapped in every way that applies: percent escapes and Unicode escapes rewrite the layer, base64
runs become layers of their own, compressed bytes are inflated. New layers join the list until none
is new; a layer that was seen at the same place is not opened again, so encodings that lead back to
themselves end. Every character of a layer remembers which characters of the text it came from,
so whatever is found has a span in the text.
"""

import base64
import binascii
import bz2
import hashlib
import itertools
import lzma
import re
import zlib

import numpy as np
import zstandard
from pyspark.sql import DataFrame, functions as F

from skywell.llm.common import fresh, mapped, query, table

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # a greedy run of 16 or more is the same as a run, then its length
PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(
    r"(?:\\x[0-9A-Fa-f]{2})+|(?:\\u[0-9A-Fa-f]{4})+|\\u\{[0-9A-Fa-f]{1,6}\}|\\U[0-9A-Fa-f]{8}|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};"
)
BASE64 = re.compile(r"(?:[A-Za-z0-9+/]{60,}\r?\n)+[A-Za-z0-9+/]+={0,2}|[A-Za-z0-9+/_-]{20,}={0,2}")
CONTROL = re.compile(r"[\x00-\x08\x0e-\x1f\x7f]")
#: Inflated bytes are read in windows. A run without a blank may fill a window of this many bytes; a longer one is
#: read in parts, and counted as unread as what it encodes as a whole is not opened.
INFLATED = 64 << 20
OVERLAP = 256  # bytes before the last blank of a window that the next one has too
MAGIC = re.compile(rb"\x1f\x8b\x08|BZh[1-9]|\xfd7zXZ\x00|\x28\xb5\x2f\xfd|\x78[\x01\x5e\x9c\xda]")
BROKEN = (OSError, zlib.error, lzma.LZMAError, EOFError, ValueError, zstandard.ZstdError)


def found_in(text: str):
    """`(kind number, start, end)` of the secrets that stand in `text` as it is."""
    for m in ASSIGN.finditer(text):
        if m.end(2) - m.start(2) >= 12:
            yield 0, m.start(), m.end()
    for m in ACCESS.finditer(text):
        if m.end() - m.start() >= 18:
            yield 1, m.start(), m.end()
    for m in HEX.finditer(text):
        yield 2, m.start(), m.end()


class Layer:
    """A text and, for each of its characters, where in the original it comes from."""

    def __init__(self, text: str, low: np.ndarray, high: np.ndarray):
        self.text, self.low, self.high = text, low, high

    @classmethod
    def of(cls, text: str):
        at = np.arange(len(text) + 1, dtype=np.int64)
        return cls(text, at[:-1], at[1:])

    def span(self, start: int, end: int) -> tuple[int, int]:
        return int(self.low[start:end].min()), int(self.high[start:end].max())

    def key(self):
        digest = hashlib.blake2b(self.text.encode("utf-8", "surrogatepass"), digest_size=16).digest()
        return digest, int(self.low.min()), int(self.high.max())


class Zstd:
    """A zstd frame with the interface of `zlib.decompressobj`; few bytes are taken at a time, as each may stand for many."""

    def __init__(self):
        self.inner, self.unconsumed_tail, self.unused_data, self.eof = zstandard.ZstdDecompressor().decompressobj(), b"", b"", False

    def decompress(self, data: bytes, size: int) -> bytes:
        out, self.unconsumed_tail = self.inner.decompress(data[:256]), data[256:]
        if self.inner.eof:
            self.eof, self.unused_data, self.unconsumed_tail = True, self.inner.unused_data + self.unconsumed_tail, b""
        return out


def opener(raw: bytes):
    """What inflates bytes that begin so, or None."""
    if raw[:2] == b"\x1f\x8b" or (len(raw) > 2 and raw[0] & 15 == 8 and (raw[0] << 8 | raw[1]) % 31 == 0):
        return lambda: zlib.decompressobj(47)
    if raw[:3] == b"BZh":
        return bz2.BZ2Decompressor
    if raw[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor
    return Zstd if raw[:4] == b"\x28\xb5\x2f\xfd" else None


class Feed:
    """Pieces of bytes that can be looked at before they are taken."""

    def __init__(self, pieces):
        self.pieces, self.held = iter(pieces), b""

    def peek(self, size: int) -> bytes:
        while len(self.held) < size and (piece := next(self.pieces, b"")):
            self.held += piece
        return self.held

    def take(self) -> bytes:
        out, self.held = self.held or next(self.pieces, b""), b""
        return out


def inflated(feed: Feed, size: int):
    """Pieces of the content of all compressed members, up to the first broken one."""
    while make := opener(feed.peek(6)):
        member, given, full = make(), b"", False
        while not member.eof:
            if not given and not full and not (given := feed.take()):
                return
            try:
                piece = member.decompress(given, size)
            except BROKEN:
                return
            given, full = getattr(member, "unconsumed_tail", b""), len(piece) >= size
            if piece:
                yield piece
        feed.held = member.unused_data + feed.held


def innermost(feed: Feed, size: int, chained: int = 100) -> Feed | None:
    """The content inflated as often as it is compressed; None if it is not, or leads back to itself.

    Layers are read as a chain. After every `chained` of them the content so far is held, so that a chain stays short;
    content of more than `INFLATED` bytes is not held, and then that of the last layer in the chain is returned.
    """
    best, seen = None, set()
    for depth in itertools.count(1):
        head = feed.peek(size)
        digest = hashlib.blake2b(head, digest_size=16).digest()
        if digest in seen or opener(head) is None:
            return best
        seen.add(digest)
        inner = Feed(inflated(feed, size))
        if not inner.peek(size):
            if best is not None and not feed.held:
                feed.held = head
            return best
        best = feed = inner
        if depth % chained == 0:
            if len(feed.peek(INFLATED + 1)) > INFLATED:
                return best
            best = feed = Feed([feed.held])


def as_text(raw: bytes) -> tuple[str, int, bool]:
    """Bytes as UTF-8 or little-endian UTF-16, the bytes of a code unit, and whether all are text without control characters."""
    if len(raw) >= 4 and 2 * raw[1::2].count(0) > len(raw) // 2:
        text, width = raw[: len(raw) // 2 * 2].decode("utf-16-le", "replace"), 2
        clean = len(raw) % 2 == 0 and not any(raw[1::2])
    else:
        text, width = raw.decode("utf-8", "surrogateescape"), 1
        clean = not any("\udc80" <= c <= "\udcff" for c in text)
    return text, width, clean and bool(text) and not CONTROL.search(text)


def worth(text: str) -> bool:
    """Whether there is anything in a text to find or open."""
    return bool(PERCENT.search(text) or ESCAPE.search(text) or BASE64.search(text) or next(found_in(text), None))


class Unwrapping:
    """The worklist of one text."""

    def __init__(self, text: str):
        self.unread, self.opened = 0, 0
        self.base = sorted(((s, k, e) for k, s, e in found_in(text)))
        self.spans = set(self.base)
        if not (PERCENT.search(text) or ESCAPE.search(text) or BASE64.search(text)):
            return
        work, seen = [self.children(Layer.of(text))], set()
        while work:  # depth first, so that few windows of an inflated layer are there at a time
            child = next(work[-1], None)
            if child is None:
                work.pop()
            elif child.text and (key := child.key()) not in seen:
                seen.add(key)
                self.opened += 1
                for k, s, e in found_in(child.text):
                    low, high = child.span(s, e)
                    self.spans.add((low, k, high))
                work.append(self.children(child))

    def children(self, layer: Layer):
        yield from self.rewritten(layer)
        yield from self.runs(layer)

    def windows(self, feed: Feed, low: int, high: int):
        """Inflated bytes as layers that overlap; a run without a blank is not cut until it fills `INFLATED`."""
        held, long = b"", False
        while True:
            piece = feed.take()
            held += piece
            cut = max(held.rfind(b" ", 0, max(len(held) - OVERLAP, 0)) - OVERLAP, 0)
            if piece and not cut:
                if len(held) <= INFLATED:
                    continue
                long, cut = True, len(held) - OVERLAP
            text = as_text(held)[0]
            yield Layer(text, np.broadcast_to(low, len(text)), np.broadcast_to(high, len(text)))
            if not piece:
                break
            held = held[cut:]
        self.unread += long

    def opened_bytes(self, raw: bytes, low: np.ndarray, high: np.ndarray, strict: bool):
        """Layers of the content of bytes that came from `low`..`high`: inflated, or as they are.

        `strict`: only bytes that are compressed from the first on, or text as a whole. Else compressed
        members anywhere in them, and the text between what is no text if there is anything in it.
        """
        size = max(INFLATED >> 6, 1)
        for at in [0] if strict else sorted({0, *(m.start() for m in MAGIC.finditer(raw))}):
            if opener(raw[at : at + 6]) and (inner := innermost(Feed([raw[at:]]), size)):
                yield from self.windows(inner, low[at:].min(), high[at:].max())
                if strict:
                    return
        text, width, clean = as_text(raw)
        if clean or (not strict and worth(text)):
            if width == 1 and len(text) == len(raw):
                yield Layer(text, low, high)
            else:
                sizes = (2 * (1 + (ord(c) > 0xFFFF)) if width == 2 else 1 if "\udc80" <= c <= "\udcff" else len(c.encode()) for c in text)
                widths = np.fromiter(sizes, np.int64, len(text))
                ends = np.cumsum(widths)
                yield Layer(text, low[ends - widths], high[np.minimum(ends, len(raw)) - 1])

    def read(self, layer: Layer, at: np.ndarray, strict: bool, known: list | None = None):
        """Layers of the base64 digits at the places `at`; bytes in one of `known` are left out, others added to it."""
        digits = "".join([layer.text[i] for i in at[: len(at) - (len(at) % 4 == 1)]]).replace("-", "+").replace("_", "/")
        try:
            raw = base64.b64decode(digits + "=" * (-len(digits) % 4))
        except binascii.Error:
            return
        if not raw or (known is not None and any(raw in k for k in known)):
            return
        byte = np.arange(len(raw))
        layers = self.opened_bytes(raw, layer.low[at[byte * 8 // 6]], layer.high[at[(byte * 8 + 7) // 6]], strict)
        for child in layers:
            if known is not None and (not known or known[-1] is not raw):
                known.append(raw)
            yield child

    def read_any(self, layer: Layer, at: np.ndarray, strict: bool):
        """`read`, True if it gave something."""
        got = False
        for child in self.read(layer, at, strict):
            got = True
            yield child
        return got

    def runs(self, layer: Layer):
        """Layers of their own: base64 runs, and escaped bytes that are compressed.

        A run is read whole. Where that is no text, it is read without its last line, which may be a word of what
        follows, then from behind a `/`, `-` or `_`, and at last line by line from each of four digits on,
        as text with other bytes in between.
        """
        for m in BASE64.finditer(layer.text):
            run = m.group().rstrip("=")
            at = np.array([m.start() + i for i, c in enumerate(run) if c not in "\r\n"], np.int64)
            if (yield from self.read_any(layer, at, True)):
                continue
            lines = [np.arange(m.start() + x.start(), m.start() + x.end()) for x in re.finditer(r"[^\r\n]+", run)]
            if len(lines) > 1 and (yield from self.read_any(layer, at[: -len(lines[-1])], True)):
                at, lines = lines[-1], lines[-1:]
            for k in np.flatnonzero([layer.text[i] in "/-_" for i in at]) + 1:
                if len(at) - k >= 20 and self.begins_text(layer, at[k : k + 64]):
                    if (yield from self.read_any(layer, at[k:], True)):
                        at, lines = at[: k - 1], [at[: k - 1]]
                        break
            known = []
            for part in [at, *lines] if len(lines) > 1 else [at]:
                for first in range(4):
                    if len(part) - first >= 16:
                        yield from self.read(layer, part[first:], False, known)

        for pattern, skip in ((PERCENT, 1), (ESCAPE, 2)):
            for m in pattern.finditer(layer.text):
                if skip == 1 or m.group().startswith("\\x"):
                    raw = bytes(int(x, 16) for x in re.findall(r"[0-9A-Fa-f]{2}", m.group()))
                    if opener(raw[:6]):
                        step = skip + 2
                        at = m.start() + np.arange(len(raw)) * step
                        if inner := innermost(Feed([raw]), max(INFLATED >> 6, 1)):
                            yield from self.windows(inner, layer.low[at].min(), layer.high[at + step - 1].max())

    def begins_text(self, layer: Layer, at: np.ndarray) -> bool:
        digits = "".join([layer.text[i] for i in at[: len(at) // 4 * 4]]).replace("-", "+").replace("_", "/")
        raw = base64.b64decode(digits)
        return bool(opener(raw[:6])) or as_text(raw[: len(raw) - 4])[2]

    def rewritten(self, layer: Layer):
        """The layer with its percent escapes, and with its Unicode escapes, replaced."""
        for pattern, decode in ((PERCENT, percent), (ESCAPE, escape)):
            texts, lows, highs, last = [], [], [], 0
            for m in pattern.finditer(layer.text):
                got = decode(m.group())
                if got is None:
                    continue
                text, ends = got
                at = m.start() + np.concatenate(([0], ends))
                texts += [layer.text[last : m.start()], text]
                lows += [layer.low[last : m.start()], layer.low[at[:-1]]]
                highs += [layer.high[last : m.start()], layer.high[at[1:] - 1]]
                last = m.end()
            if texts:
                yield Layer(
                    "".join(texts) + layer.text[last:],
                    np.concatenate([*lows, layer.low[last:]]), np.concatenate([*highs, layer.high[last:]]),
                )


def byte_run(raw: bytes, step: int):
    """UTF-8 bytes written `step` characters each: the text and where each character's writing ends."""
    try:
        text = raw.decode("utf-8")
    except UnicodeDecodeError:
        return None
    return text, np.cumsum([step * len(c.encode()) for c in text], dtype=np.int64)


def percent(run: str):
    return byte_run(bytes.fromhex(run.replace("%", "")), 3)


def escape(run: str):
    if run.startswith("\\x"):
        raw = bytes.fromhex(run.replace("\\x", ""))
        return byte_run(raw, 4) or (raw.decode("latin-1"), 4 * np.arange(1, len(raw) + 1))
    if run.startswith("\\u") and run[2] != "{":
        text = bytes.fromhex(run.replace("\\u", "")).decode("utf-16-be", "surrogatepass")
        return text, np.cumsum([12 if ord(c) > 0xFFFF else 6 for c in text], dtype=np.int64)
    digits = re.search(r"[0-9A-Fa-f]+", run[3 if run[:3] in ("&#x", "&#X") else 2 :]).group()
    point = int(digits, 10 if re.match(r"&#[0-9]", run) else 16)
    return None if point > 0x10FFFF else (chr(point), np.array([len(run)]))


SPANS = "array<struct<kind:string,start:long,end:long>>"


def find_secrets(df: DataFrame, text: str = "text", keep: tuple = ("doc_id",)) -> DataFrame:
    """Add `base_spans` (as the text stands), `spans` (all layers), `layers` and `unread` to `keep`.

    Positions are code points, ends exclusive, ordered by start, then kind. A null text is empty
    and has no span; repeated rows repeat; other columns are not read. `unread` counts inflated
    layers with a run too long for one window, which is read in parts.
    """

    def named(spans):
        return [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in sorted(spans)]

    def search(texts):
        got = [Unwrapping(t or "") for t in texts]
        return [named(u.base) for u in got], [named(u.spans) for u in got], [u.opened for u in got], [u.unread for u in got]

    names = [fresh(n, keep) for n in ("base_spans", "spans", "layers", "unread")]
    out = f"`{names[0]}` {SPANS}, `{names[1]}` {SPANS}, `{names[2]}` int, `{names[3]}` int"
    return mapped(df, text, keep, out, search)


def redacted(df: DataFrame, text: str = "text") -> DataFrame:
    """All columns, with every secret's characters replaced by `[secret]`; other text stays as it is.

    Spans that touch or overlap become one. Null texts stay null; `n_chars`, if there, follows the text.
    """

    def cover(texts):
        out = []
        for t in texts:
            if t:
                parts, last = [], 0
                spans = sorted((s, e) for s, _, e in Unwrapping(t).spans)
                for i, (s, e) in enumerate(spans):
                    if s > last or not i:
                        parts += [t[last:s], "[secret]"]
                    last = max(last, e)
                t = "".join(parts) + t[last:]
            out.append(t)
        return [out]

    made = fresh("redacted", df.columns)
    same = mapped(df, text, df.columns, f"`{made}` string", cover)
    out = [F.col(f"`{made}`").alias(c) if c == text else F.col(f"`{c}`") for c in df.columns]
    if "n_chars" in df.columns:
        size = F.when(F.col(f"`{made}`") != F.col(f"`{text}`"), F.length(f"`{made}`").cast("long"))
        at = df.columns.index("n_chars")
        out[at] = F.coalesce(size, F.col("n_chars").cast("long")).alias("n_chars")
    return same.select(*out)


def joined(spans: str):
    """`kind:start:end` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


@query()
def op3_secrets(spark, sf_dir):
    """Secrets of every document, as it stands and through all its layers."""
    found = find_secrets(table(spark, sf_dir, "documents"))
    kinds = F.transform("base_spans", lambda x: x["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(joined("base_spans"), 256).alias("base_sha256"), joined("spans").alias("spans"),
        "layers", "unread",
    )
