"""Plain-Python statement of the recursive splitter, used only by tests as the
brute-force check of the native chunk expression."""

from __future__ import annotations

import re

SEPARATORS = ["\n\n\n", "\n\n", "\n", ". ", " ", ""]
_TOKEN = re.compile(r"[^\W_]+|[^ \t\n\r\f\w]|_", re.UNICODE)
_WS = " \t\n\r\f"


def count_tokens(s: str) -> int:
    # letters/digits runs, every other non-whitespace char alone
    return len(_TOKEN.findall(s))


def _split_keep_start(text: str, sep: str) -> list[str]:
    if sep == "":
        return [c for c in text]
    parts = re.split(f"({re.escape(sep)})", text)
    out = [parts[0]] + [parts[i] + parts[i + 1] for i in range(1, len(parts) - 1, 2)]
    return [p for p in out if p != ""]


def _merge(splits, size, overlap, length):
    docs, cur, total = [], [], 0
    for d in splits:
        n = length(d)
        if total + n > size:
            if cur:
                doc = "".join(cur).strip(_WS)
                if doc:
                    docs.append(doc)
                while total > overlap or (total + n > size and total > 0):
                    total -= length(cur[0])
                    cur = cur[1:]
        cur.append(d)
        total += n
    doc = "".join(cur).strip(_WS)
    if doc:
        docs.append(doc)
    return docs


def split_text(text: str, size: int, overlap: int = 0, length=count_tokens,
               separators=SEPARATORS) -> list[str]:
    sep = separators[-1]
    rest: list[str] = []
    for i, s in enumerate(separators):
        if s == "":
            sep = s
            break
        if s in text:
            sep = s
            rest = separators[i + 1:]
            break
    out, good = [], []
    for piece in _split_keep_start(text, sep):
        if length(piece) < size:
            good.append(piece)
        else:
            if good:
                out.extend(_merge(good, size, overlap, length))
                good = []
            if not rest:
                stripped = piece.strip(_WS)
                if stripped:
                    out.append(stripped)
            else:
                out.extend(split_text(piece, size, overlap, length, rest))
    if good:
        out.extend(_merge(good, size, overlap, length))
    return out
