"""Records of delimited text, read as a stream: encoding, quotes and line breaks.

A quote opens a cell only at the cell's start (``5" tube`` has a plain one) and closes it
only before a separator or the end of a line. A line break inside an open cell belongs to
it. A cell that stays open for ``RECORD_CHARS`` characters or to the end of the text was
not meant to be quoted: its quote is a plain character, the record ends with its line, and
reading goes on with the next line. So nothing but a record is held, and nothing is lost.
"""

from __future__ import annotations

import codecs
import io
import re
from collections import deque
from collections.abc import Iterator
from typing import BinaryIO

from callejero import constants as K

RECORD_CHARS = 64 * 1024
CHUNK_BYTES = 1 << 20
# the longest UTF-8 character, less its last byte
CUT_BYTES = 3
LINE_END = re.compile(r"\r\n|\n|\r")


def decode(raw: bytes, whole: bool) -> tuple[str, str]:
    """Text and encoding of some bytes: UTF-8, or Latin-1 where they are no UTF-8.

    Only where the bytes are not the ``whole`` text may they end inside a character.
    """
    try:
        return raw.decode("utf-8"), "UTF-8"
    except UnicodeDecodeError as error:
        cut = not whole and error.reason == "unexpected end of data" and len(raw) - error.start <= CUT_BYTES
        return (raw[: error.start].decode("utf-8"), "UTF-8") if cut else (raw.decode("latin-1"), "ISO-8859-1")


def encoding_of(stream: BinaryIO) -> str:
    """Encoding of a whole stream: UTF-8 if every byte of it is, else Latin-1."""
    decoder = codecs.getincrementaldecoder("utf-8")()
    try:
        while chunk := stream.read(CHUNK_BYTES):
            decoder.decode(chunk)
        decoder.decode(b"", final=True)
    except UnicodeDecodeError:
        return "ISO-8859-1"
    return "UTF-8"


def lines_of(stream: BinaryIO, encoding: str) -> Iterator[str]:
    """Lines with their ends, without a byte order mark."""
    for number, line in enumerate(io.TextIOWrapper(stream, encoding=encoding, errors="replace", newline="")):
        yield line.removeprefix("\ufeff") if number == 0 else line


def stays_open(line: str, separators: str, is_open: bool = False) -> bool:
    """Whether a quoted cell is open at the end of a line, which began inside one or not."""
    at = line.find('"')
    while at >= 0:
        if not is_open:
            is_open = at == 0 or line[at - 1] in separators
        elif line[at + 1:at + 2] == '"':   # a quote written twice
            at += 1
        else:
            is_open = not _ends_cell(line, at, separators)
        at = line.find('"', at + 1)
    return is_open


def _ends_cell(line: str, at: int, separators: str) -> bool:
    """Whether a quote stands before a separator or the end of the line."""
    after = line[at + 1:at + 2]
    return not after or after in separators or after in "\r\n"


def records(lines: Iterator[str], separators: str, multi_line: bool = True) -> Iterator[str]:
    """Non-blank records without their line ends."""
    waiting: deque[str] = deque()
    lines = iter(lines)
    while True:
        line = waiting.popleft() if waiting else next(lines, None)
        if line is None:
            return
        if multi_line and '"' in line and stays_open(line, separators):
            held, size, is_open = [line], len(line), True
            while is_open and size < RECORD_CHARS:
                more = waiting.popleft() if waiting else next(lines, None)
                if more is None:
                    break
                held.append(more)
                size += len(more)
                is_open = stays_open(more, separators, True)
            if is_open:
                waiting.extendleft(reversed(held[1:]))
            else:
                line = "".join(held)
        line = line.rstrip("\r\n")
        if line.strip():
            yield line


def cells(record: str, separator: str) -> list[str]:
    """Cells of a record; where a quoted cell never closes, its quotes are plain characters."""
    if '"' not in record:
        return record.split(separator)
    is_open = False
    for line in record.splitlines(True):
        is_open = stays_open(line, separator, is_open)
    if is_open:
        return record.split(separator)
    out, at = [], 0
    while True:
        if record[at:at + 1] != '"':
            end = record.find(separator, at)
            out.append(record[at:] if end < 0 else record[at:end])
        else:
            text, begun = "", at + 1
            while True:
                end = record.index('"', begun)
                if record[end + 1:end + 2] == '"':
                    text, begun = text + record[begun:end + 1], end + 2
                elif _ends_cell(record, end, separator):
                    text += record[begun:end]
                    break
                else:
                    text, begun = text + record[begun:end + 1], end + 1
            out.append(text)
            end = record.find(separator, end + 1)
        if end < 0:
            return out
        at = end + 1


def header_names(line: str, separator: str, taken: tuple[str, ...] = ()) -> list[str]:
    """Column names of a header record, unique whatever their case."""
    names: list[str] = []
    used = set(taken)
    for i, cell in enumerate(cells(line, separator)):
        name = cell.strip() or f"_c{i}"
        while name.lower() in used:
            name = f"{name}.{i}"
        names.append(name)
        used.add(name.lower())
    return names


def head_records(text: str, whole: bool, limit: int) -> list[str]:
    """The first records of a text; the last line counts only if it is ended or the text is ``whole``."""
    lines = text.removeprefix("\ufeff")
    parts = re.findall(r"[^\r\n]*(?:\r\n|\n|\r)|[^\r\n]+\Z", lines)
    if not whole and parts and not LINE_END.search(parts[-1]):
        parts.pop()
    found = []
    for record in records(iter(parts), "".join(K.SEPARATORS)):
        found.append(record)
        if len(found) == limit:
            break
    return found
