"""LZO1X streams, by the published description of the format's instructions."""

from __future__ import annotations


class LZOError(ValueError):
    pass


class _Input:
    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def byte(self) -> int:
        if self.at >= len(self.data):
            raise LZOError("the stream ends inside an instruction")
        self.at += 1
        return self.data[self.at - 1]

    def take(self, n: int) -> bytes:
        if self.at + n > len(self.data):
            raise LZOError("the stream ends inside literals")
        self.at += n
        return self.data[self.at - n : self.at]

    def length(self, bits: int, full: int) -> int:
        """A length of so many bits; 0 means that bytes follow, 255 for each zero."""
        if bits:
            return bits
        n = full
        while not (b := self.byte()):
            n += 255
        return n + b


def decompress(data: bytes) -> bytes:
    """The content of a raw stream, which must end with its end marker."""
    src, out = _Input(bytes(data)), bytearray()
    state = 0  # literals copied after the last instruction; 4 after a long run
    if src.data and src.data[0] > 17:
        n = src.byte() - 17
        out += src.take(n)
        state = min(n, 4)
    while True:
        op = src.byte()
        if op >= 64:
            high = src.byte()
            distance, size, state = (high << 3) + (op >> 2 & 7) + 1, (op >> 5) + 1, op & 3
        elif op >= 16:
            far = op < 32
            size = src.length(op & (7 if far else 31), 7 if far else 31) + 2
            pair = src.byte() | src.byte() << 8
            distance = (16384 + ((op & 8) << 11) if far else 1) + (pair >> 2)
            state = pair & 3
            if far and distance == 16384:
                if src.at != len(src.data):
                    raise LZOError("bytes after the end marker")
                return bytes(out)
        elif state == 0:
            out += src.take(src.length(op, 15) + 3)
            state = 4
            continue
        else:
            distance, size = (src.byte() << 2) + (op >> 2) + (2049 if state == 4 else 1), 3 if state == 4 else 2
            state = op & 3
        if distance > len(out):
            raise LZOError("a copy from before the beginning")
        for _ in range(size):
            out.append(out[-distance])
        if state:
            out += src.take(state)
