"""Records of an XML file of any size, cut out of its byte stream.

A file is read twice as a stream: once to see that it is well-formed to its end, since a damaged
file must not give anything, and once to find where its records begin and end.  Records, at any
depth, are handed out a few megabytes at a time below the root's own tag, as they were written.
Files in other encodings are turned into UTF-8 on the way.  Names are compared as XML has it: in a
file with a default namespace no element has a bare name, so such a file has no records.
"""

from __future__ import annotations

import codecs
import lzma
import re
import sys
import zipfile
import zlib
from collections.abc import Callable, Iterator
from io import BytesIO
from typing import BinaryIO
from xml.parsers import expat

from pyspark import cloudpickle

# executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DOCUMENT_BYTES = 4 << 20
"""About as much of a file as is handed out at a time."""

DAMAGED = (
    expat.ExpatError, UnicodeError, LookupError, zipfile.BadZipFile, zlib.error, lzma.LZMAError, OSError, EOFError,
    NotImplementedError,
)
"""What reading a damaged or unreadable file raises; bzip2 says so by an OSError, storage must not."""

_BLOCK = 1 << 20
_TAG = re.compile(rb"""<(?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")
_DECLARED = re.compile(rb"(?:\xef\xbb\xbf)?<\?xml\s[^<>]*\?>")
_SLASH = ord("/")
_MARKS = ((codecs.BOM_UTF8, "utf-8"), (codecs.BOM_UTF16_LE, "utf-16"), (codecs.BOM_UTF16_BE, "utf-16"))


def _blocks(stream: BinaryIO, name: str | None) -> Iterator[bytes]:
    """The stream in UTF-8, from its own encoding unless one is named; invalid bytes raise."""
    head = stream.read(_BLOCK)
    name = name or next((name for mark, name in _MARKS if head.startswith(mark)), None)
    if name is None:
        declared = re.match(rb"\s*<\?xml[^>]*?encoding\s*=\s*[\"']([\w.-]+)", head[:200])
        name = declared.group(1).decode("ascii") if declared else "utf-8"
    same = codecs.lookup(name).name == "utf-8"
    decoder = None if same else codecs.getincrementaldecoder(name)("strict")
    while head:
        yield head if decoder is None else decoder.decode(head).encode("utf-8")
        head = stream.read(_BLOCK)
    if decoder is not None:
        yield decoder.decode(b"", True).encode("utf-8")


def _parser() -> expat.XMLParserType:
    return expat.ParserCreate("utf-8", " ")


def check(stream: BinaryIO, encoding: str | None = None) -> None:
    """Raise unless the file is well-formed to its end."""
    parser = _parser()
    for block in _blocks(stream, encoding):
        parser.Parse(block, False)
    parser.Parse(b"", True)


def _cut(stream: BinaryIO, record: str, encoding: str | None) -> Iterator[tuple[bytes, bytes]]:
    """``(root's tag, record)`` of every record in the stream."""
    parser, held, base = _parser(), bytearray(), 0
    root: list[int] = []
    opened: list[int] = []
    closed: list[tuple[int, int]] = []

    def start(name: str, _) -> None:
        if not root:
            root.append(parser.CurrentByteIndex)
        if name == record:
            opened.append(parser.CurrentByteIndex)

    def end(name: str) -> None:
        if name == record:
            closed.append((opened.pop(), parser.CurrentByteIndex))

    parser.StartElementHandler, parser.EndElementHandler = start, end
    tag = b""
    for block in _blocks(stream, encoding):
        held += block
        parser.Parse(block, False)
        if root and not tag:
            tag = _TAG.match(held, root[0] - base).group()
            tag = tag[:-2].rstrip() + b">" if tag.endswith(b"/>") else tag
        for first, last in closed:
            opening = _TAG.match(held, first - base)
            closing = opening if opening.group().endswith(b"/>") else _TAG.match(held, last - base)
            yield tag, bytes(held[first - base : closing.end()])
        closed.clear()
        used = min(opened, default=parser.CurrentByteIndex if root else 0) - base
        if used > 0:
            del held[:used]
            base += used
    parser.Parse(b"", True)


def _tags(record: str) -> re.Pattern[bytes]:
    return re.compile(rb"<(/?)" + re.escape(record.encode()) + rb"""(?=[\s/>])(?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")


def _cut_held(data: bytes, record: str) -> list[tuple[bytes, bytes]]:
    """What ``_cut`` gives for a whole file in UTF-8.

    In a file without comments, sections, instructions and namespaces every ``<`` begins a tag, so
    that records are found by a search for theirs; only whether it is well-formed is left to the
    parser.  Other files, and those with records inside records, go through the parser's events.
    """
    declared = _DECLARED.match(data)
    begin = declared.end() if declared else 0
    if not (b"<!" in data or b"xmlns" in data or ":" in record or data.find(b"<?", begin) >= 0):
        _parser().Parse(data, True)
        found, first = [], None
        for tag in _tags(record).finditer(data, begin):
            if tag[1]:
                found.append(data[first : tag.end()])
                first = None
            elif first is not None:
                break
            elif data[tag.end() - 2] == _SLASH:
                found.append(tag[0])
            else:
                first = tag.start()
        else:
            root = _TAG.match(data, data.find(b"<", begin))[0]
            root = root[:-2].rstrip() + b">" if root.endswith(b"/>") else root
            return [(root, one) for one in found]
    return list(_cut(BytesIO(data), record, "utf-8"))


def documents(
    opened: Callable[[], BinaryIO],
    record: str,
    size: int = DOCUMENT_BYTES,
    encoding: str | None = None,
    hold: bool = False,
) -> Iterator[str]:
    """The records of a file as documents of about ``size`` bytes.

    Raises one of ``DAMAGED`` before the first of them if the file is damaged.  A file without
    records gives none.  ``encoding`` overrides what the file says, for text that was decoded once.
    ``hold`` keeps the records of a file that is known to be small until its end was seen, and so
    reads it once; the result is the same.
    """
    if not hold:
        with opened() as stream:
            check(stream, encoding)
    with opened() as stream:
        tag, parts, waiting = b"", [], 0
        found = _cut_held(b"".join(_blocks(stream, encoding)), record) if hold else _cut(stream, record, encoding)

        def document() -> str:
            name = re.match(rb"<([^\s/>]+)", tag).group(1)
            return (tag + b"".join(parts) + b"</" + name + b">").decode("utf-8")

        for tag, part in found:
            parts.append(part)
            waiting += len(part)
            if waiting >= size:
                yield document()
                parts, waiting = [], 0
        if parts:
            yield document()
