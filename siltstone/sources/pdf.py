"""The text layer of PDF files, read with the standard library: spans with places and sizes, and laid-out text.

Objects are found by their marks, so broken cross-reference tables don't matter; object streams are read, streams may be
plain or deflated. Fonts map codes by their ToUnicode tables, others by Latin-1. Encrypted files raise. Pages without
text are given to ``PAGE_READER`` (a function from the images of a page to its text), if there is one.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

OBJECT = re.compile(rb"(?<!\d)(\d+)\s+\d+\s+obj\b(.*?)\bendobj\b", re.S)
STREAM = re.compile(rb"stream\r?\n(.*?)\r?\n?endstream", re.S)
LEX = re.compile(rb"%[^\r\n]*|<<|>>|\[|\]|/[^\s/<>\[\]()%]*|\(|<[0-9A-Fa-f\s]*>|[^\s/<>\[\]()%]+")
ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}
LIST = re.compile(r"\s*(?:[•●○▪◦\-]|\d+\.)")
#: Reads pages without a text layer, if set.
PAGE_READER: Callable[[list[bytes]], str] | None = None


class Ref(int):
    """The number of an object."""


def literal(data: bytes, at: int) -> tuple[bytes, int]:
    """The string whose bracket opens before ``at``, and where it ends."""
    out, depth = bytearray(), 1
    while at < len(data):
        c = data[at : at + 1]
        at += 1
        if c == b"\\":
            if m := re.compile(rb"[0-7]{1,3}").match(data, at):
                out.append(int(m[0], 8) & 255)
                at = m.end()
                continue
            c = data[at : at + 1]
            at += 1
            if c not in b"\r\n":
                out += ESCAPES.get(c, c)
            continue
        depth += (c == b"(") - (c == b")")
        if not depth:
            break
        out += c
    return bytes(out), at


def lexed(data: bytes) -> Iterator[tuple[str, object]]:
    """Tokens: ``str`` (bytes), ``name``, ``num``, ``mark`` (brackets) and ``op`` (anything else)."""
    at = 0
    while m := LEX.search(data, at):
        t, at = m[0], m.end()
        if t[:1] == b"%":
            continue
        if t == b"(":
            s, at = literal(data, at)
            yield "str", s
        elif t in (b"<<", b">>", b"[", b"]"):
            yield "mark", t
        elif t[:1] == b"<":
            h = b"".join(t[1:-1].split())
            yield "str", bytes.fromhex((h + b"0" * (len(h) % 2)).decode())
        elif t[:1] == b"/":
            yield "name", re.sub(rb"#([0-9A-Fa-f]{2})", lambda x: bytes.fromhex(x[1].decode()), t[1:]).decode("latin-1")
        elif re.fullmatch(rb"[+-]?(?:\d+\.?\d*|\.\d+)", t):
            yield "num", float(t)
        else:
            yield "op", t


def value_of(data: bytes):
    """The first value in ``data``: dict, list, name, number, bytes or ``Ref``."""
    stack: list[list] = [[]]
    for kind, t in lexed(data):
        here = stack[-1]
        if t in (b"<<", b"["):
            stack.append([])
        elif t in (b">>", b"]"):
            if len(stack) < 2:
                break
            items = stack.pop()
            stack[-1].append(dict(zip(items[::2], items[1::2])) if t == b">>" else items)
        elif t == b"R" and len(here) >= 2:
            here.pop()
            here.append(Ref(here.pop()))
        elif t in (b"true", b"false", b"null"):
            here.append({b"true": True, b"false": False}.get(t))
        elif kind == "op":
            break
        else:
            here.append(t)
    return stack[0][0] if stack[0] else None


class Pdf:
    """The objects of a file."""

    def __init__(self, data: bytes):
        if b"/Encrypt" in data:
            raise ValueError("encrypted")
        self.raw: dict[int, bytes] = {int(m[1]): m[2] for m in OBJECT.finditer(data)}
        for body in list(self.raw.values()):
            if b"/ObjStm" in body:
                info, inner = value_of(body), self.data(body)
                numbers = inner[: int(info["First"])].split()
                starts = [int(x) + int(info["First"]) for x in numbers[1::2]] + [len(inner)]
                for k, n in enumerate(numbers[::2]):
                    self.raw.setdefault(int(n), inner[starts[k] : starts[k + 1]])

    def get(self, x):
        seen = 0
        while isinstance(x, Ref) and seen < 50:
            x, seen = value_of(self.raw.get(x, b"")), seen + 1
        return x

    def data(self, body: bytes) -> bytes:
        """The stream of an object, inflated; empty if its filter is unknown."""
        m = STREAM.search(body)
        if not m:
            return b""
        info = value_of(body) or {}
        filters = self.get(info.get("Filter"))
        filters = [filters] if isinstance(filters, str) else [self.get(f) for f in filters or []]
        out = m[1]
        for f in filters:
            if f != "FlateDecode":
                return b""
            out = zlib.decompressobj().decompress(out)
        return out

    def pages(self) -> list[dict]:
        """The pages in order, with inherited resources."""
        values = {n: value_of(b) for n, b in self.raw.items()}
        root = next((v for v in values.values() if isinstance(v, dict) and v.get("Type") == "Catalog"), {})
        out: list[dict] = []

        def walk(x, resources, depth):
            v = self.get(x)
            if not isinstance(v, dict) or depth > 60:
                return
            resources = v.get("Resources", resources)
            if v.get("Type") == "Page":
                out.append({**v, "Resources": resources})
            for kid in self.get(v.get("Kids")) or []:
                walk(kid, resources, depth + 1)

        walk(root.get("Pages"), None, 0)
        return out or [values[n] for n in sorted(values) if isinstance(values[n], dict) and values[n].get("Type") == "Page"]

    def content(self, page: dict) -> bytes:
        c = page.get("Contents")
        parts = c if isinstance(c, list) else self.get(c) if isinstance(self.get(c), list) else [c]
        return b"\n".join(self.data(self.raw.get(r, b"")) for r in parts if isinstance(r, Ref))

    def fonts(self, page: dict) -> dict[str, tuple[dict[int, str], int, bool]]:
        """By name: the table of codes, the bytes of a code, and whether the font is bold."""
        out = {}
        for name, ref in ((self.get((self.get(page.get("Resources")) or {}).get("Font"))) or {}).items():
            font = self.get(ref) or {}
            to = font.get("ToUnicode")
            table = unicode_table(self.data(self.raw.get(to, b""))) if isinstance(to, Ref) else {}
            out[name] = (table, 2 if font.get("Subtype") == "Type0" else 1, "bold" in str(self.get(font.get("BaseFont"))).lower())
        return out

    def images(self, page: dict) -> list[bytes]:
        """The images of a page that stand in the file as JPEG."""
        out = []
        for ref in ((self.get((self.get(page.get("Resources")) or {}).get("XObject"))) or {}).values():
            body = self.raw.get(ref, b"") if isinstance(ref, Ref) else b""
            if b"/Image" in body and b"/DCTDecode" in body and (m := STREAM.search(body)):
                out.append(m[1])
        return out


def unicode_table(cmap: bytes) -> dict[int, str]:
    """Codes to text from the ``bfchar`` and ``bfrange`` sections of a ToUnicode stream."""
    out: dict[int, str] = {}
    number = lambda b: int.from_bytes(b, "big")
    for kind, body in re.findall(rb"begin(bfchar|bfrange)(.*?)end\1", cmap, re.S):
        held: list = []
        listed = False
        for what, t in lexed(body):
            if t == b"[":
                listed, items = True, []
            elif t == b"]":
                listed = False
                for k, s in enumerate(items):
                    out[number(held[0]) + k] = s.decode("utf-16-be", "replace")
                held = []
            elif what == "str":
                (items if listed else held).append(t)
                if kind == b"bfchar" and len(held) == 2:
                    out[number(held[0])] = held[1].decode("utf-16-be", "replace")
                    held = []
                elif kind == b"bfrange" and len(held) == 3:
                    for k in range(number(held[1]) - number(held[0]) + 1):
                        out[number(held[0]) + k] = (held[2][:-2] + (number(held[2][-2:]) + k).to_bytes(2, "big")).decode("utf-16-be", "replace")
                    held = []
    return out


def page_spans(pdf: Pdf, page: dict) -> list[tuple[float, float, str, float, int]]:
    """(y, x, text, size, flags) of the shown strings of a page, in order; flag 8: bold."""
    fonts = pdf.fonts(page)
    table, width, bold, size, leading = {}, 1, False, 12.0, 0.0
    line = [1.0, 0.0, 0.0, 1.0, 0.0, 0.0]
    out: list[tuple[float, float, str, float, int]] = []
    args: list = []
    held: list | None = None

    def decoded(s: bytes) -> str:
        codes = [int.from_bytes(s[i : i + width], "big") for i in range(0, len(s), width)]
        return "".join(table.get(c, chr(c) if width == 1 else "") for c in codes)

    def move(x: float, y: float) -> None:
        line[4] += x * line[0] + y * line[2]
        line[5] += x * line[1] + y * line[3]

    def show(parts: list) -> None:
        text = "".join(decoded(p) if isinstance(p, bytes) else " " if p < -200 else "" for p in parts)
        if text:
            out.append((line[5], line[4], text, size * (line[2] ** 2 + line[3] ** 2) ** 0.5, 8 if bold else 0))

    for kind, t in lexed(pdf.content(page)):
        if t == b"[":
            held = []
        elif t == b"]":
            args.append(held or [])
            held = None
        elif kind != "op":
            (args if held is None else held).append(t)
        else:
            try:
                if t == b"Tf":
                    (table, width, bold), size = fonts.get(args[-2], ({}, 1, False)), args[-1]
                elif t == b"BT":
                    line = [1.0, 0.0, 0.0, 1.0, 0.0, 0.0]
                elif t == b"Tm":
                    line = list(args[-6:])
                elif t == b"TL":
                    leading = args[-1]
                elif t in (b"Td", b"TD"):
                    leading = -args[-1] if t == b"TD" else leading
                    move(args[-2], args[-1])
                elif t == b"T*":
                    move(0, -leading)
                elif t == b"Tj":
                    show([args[-1]])
                elif t == b"TJ":
                    show(args[-1])
                elif t in (b"'", b'"'):
                    move(0, -leading)
                    show([args[-1]])
            except (IndexError, TypeError):
                pass  # an operator without its operands
            args = []
    return out


def spans(data: bytes) -> list[tuple[int, int, float, str, float, int]]:
    """(page, line, x, text, size, flags) of a file; spans whose places differ by less than half their size share a line."""
    pdf, out = Pdf(data), []
    for no, page in enumerate(pdf.pages()):
        found = sorted(page_spans(pdf, page), key=lambda s: -s[0])
        row, last = -1, None
        for y, x, text, size, flags in found:
            if last is None or last - y > max(1.0, size / 2):
                row, last = row + 1, y
            out.append((no, row, x, text, size, flags))
    return out


def pdf_text(data: bytes) -> str:
    """Lines of all pages, headings as ``## … ##``, list items behind a bullet; pages are joined by blank lines."""
    pdf, pages = Pdf(data), []
    lines: dict[tuple[int, int], list] = {}
    for no, row, *span in spans(data):
        lines.setdefault((no, row), []).append(span)
    for no, page in enumerate(pdf.pages()):
        rows = []
        for key in sorted(k for k in lines if k[0] == no):
            parts = sorted(lines[key], key=lambda s: s[0])
            text = "".join(t for _, t, _, _ in parts)
            if any(size > 14 or size > 12 and flags & 8 for _, _, size, flags in parts):
                text = f"## {text.strip()} ##"
            elif LIST.match(text):
                text = f"• {text.strip()}"
            rows.append(text)
        if not any(r.strip() for r in rows) and PAGE_READER:
            rows = [PAGE_READER(pdf.images(page))]
        pages.append("\n".join(rows))
    return "\n\n".join(p for p in pages if p.strip())
