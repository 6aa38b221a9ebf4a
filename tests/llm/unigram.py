"""The vocabulary file with its model type set to unigram, for the library to compare with."""

import struct

import sentencepiece

UNIGRAM = 1


def _number(raw, at):
    value = shift = 0
    while True:
        b = raw[at]
        at += 1
        value |= (b & 127) << shift
        shift += 7
        if b < 128:
            return value, at


def _varint(n):
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _fields(raw):
    at = 0
    while at < len(raw):
        begin = at
        tag, at = _number(raw, at)
        if tag & 7 == 0:
            _, at = _number(raw, at)
            body = at
        elif tag & 7 == 2:
            size, body = _number(raw, at)
            at = body + size
        else:
            body = at
            at += 4 if tag & 7 == 5 else 8
        yield tag >> 3, raw[begin:at], raw[body:at]


def convert(path, to):
    """Write the file with its model type as unigram (field 3 of the settings in field 2).

    The runs of spaces have a score of -1e9 there; sums with it lose 32-bit precision in the
    library, so they get -50000 here.
    """
    out = b""
    for field, whole, body in _fields(open(path, "rb").read()):
        if field == 1:
            low = b"\x15" + struct.pack("<f", -1e9)
            piece = b"".join(b"\x15" + struct.pack("<f", -50000.0) if w == low else w for _, w, _ in _fields(body))
            whole = b"\x0a" + _varint(len(piece)) + piece
        if field == 2:
            settings = b"".join(w for f, w, _ in _fields(body) if f != 3) + b"\x18" + bytes([UNIGRAM])
            whole = b"\x12" + _varint(len(settings)) + settings
        out += whole
    with open(to, "wb") as f:
        f.write(out)
    return sentencepiece.SentencePieceProcessor(model_file=str(to))
