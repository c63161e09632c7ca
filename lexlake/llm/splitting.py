"""Problem 9: texts over a size limit, cut into pieces at natural boundaries.

The token offsets of a text are prefix sums over its bytes. Its natural boundaries, of four
strengths, are sorted arrays over the same offsets. Each piece ends at the last boundary within
the limit, found by binary search, the strongest kind that leaves the piece at least half full
first; without any boundary it is cut hard, between two characters. The next piece begins
overlap tokens before that end.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexlake.llm.tokens import TOKENIZER, encoder, vocabulary

#: Ends of paragraphs, lines and sentences, clauses, words.
KINDS = tuple(
    re.compile(p)
    for p in (r"\n\s*\n\s*", r"\n+|[.!?…]+[\"'”’»)\]]*(?=\s)\s+|[。！？]+[」』”’》）]*\s*", r"[,;:](?=\s)\s+|[，；：、]\s*", r"\s+|(?<=[぀-ヿ㐀-鿿])(?=[぀-ヿ㐀-鿿])")
)
FULL = 0.5


def pieces(text: str, enc, limit: int, overlap: int) -> list[tuple[int, int, int, int]]:
    """(begin, end, tokens, overlap tokens) of each piece, as character places in text.

    One piece if text has no more than limit tokens. Pieces cover the text; none has more than
    limit tokens by itself. A text with a token of several characters or a character of several
    tokens is never cut inside a character.
    """
    if limit < 1 or overlap < 0 or overlap >= limit:
        raise ValueError("the limit must be above the overlap, and the overlap 0 or more")
    ids = enc.encode_ordinary(text)
    if len(ids) <= limit:
        return [(0, len(text), len(ids), 0)]
    size = np.fromiter(map(len, enc.decode_tokens_bytes(ids)), np.int64, len(ids))
    at = np.zeros(len(ids) + 1, np.int64)
    np.cumsum(size, out=at[1:])  # byte offset at which each token begins
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    lead = np.flatnonzero((raw & 0xC0) != 0x80)  # byte offset of each character
    char = np.searchsorted(lead, at)  # the first character that begins at or after each token
    clean = np.ones(len(at), bool)
    clean[:-1] = lead[np.minimum(char[:-1], len(lead) - 1)] == at[:-1]
    # The tokens after which a text may be cut: token boundaries that are character boundaries.
    cuts = [np.unique(np.searchsorted(char, np.array([m.end() for m in kind.finditer(text)], np.int64), side="right") - 1) for kind in KINDS]
    cuts = [c[clean[c]] for c in cuts]
    hard = np.flatnonzero(clean)
    out, begin, shared = [], 0, 0
    while True:
        room = limit
        while True:
            last = begin + room
            if last >= len(ids):
                end = len(ids)
            else:
                end = -1
                for c in cuts:
                    k = int(np.searchsorted(c, last, side="right")) - 1
                    if k >= 0 and c[k] > begin + max(shared, int(room * FULL)):
                        end = int(c[k])
                        break
                if end < 0:
                    end = int(hard[np.searchsorted(hard, last, side="right") - 1])
                    if end <= begin + shared:  # one character is longer than the room
                        end = int(hard[np.searchsorted(hard, begin + shared, side="right")])
            n = len(enc.encode_ordinary(text[char[begin] : char[end]]))
            if n <= limit or room <= shared + 1:
                break
            room -= max(1, n - limit)  # a cut inside a word can make more tokens
        out.append((int(char[begin]), int(char[end]), n, shared))
        if end == len(ids):
            return out
        back = int(hard[np.searchsorted(hard, max(0, end - overlap), side="right") - 1])
        back = max(back, begin + 1)
        begin, shared = back, end - back


def split(df: DataFrame, row_id: str, text: str, limit: int, overlap: int, tokenizer: str = TOKENIZER, only_long: bool = False) -> DataFrame:
    """(row_id, piece, pieces, n_tokens, overlap_tokens, text): every text as pieces within limit tokens.

    A null text gives no row, an empty one one empty piece; a row that stands twice is split
    twice. With only_long, texts that fit into one piece are left out. A text of no more bytes
    than limit can't have more tokens, so it isn't tokenized then.
    """
    data, kind = vocabulary(tokenizer), dict(df.dtypes)[row_id]
    rows = df.select(F.col(row_id).alias("row_id"), F.col(text).alias("text")).where("text is not null")
    if only_long:
        rows = rows.where(F.octet_length("text") > limit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(data)
        for batch in batches:
            source, out = [], []
            for i, t in enumerate(batch.column("text").to_pylist()):
                cut = pieces(t, enc, limit, overlap)
                if only_long and len(cut) == 1:
                    continue
                for k, (a, b, n, o) in enumerate(cut):
                    source.append(i)
                    out.append((k, len(cut), n, o, t[a:b]))
            k, m, n, o, t = zip(*out) if out else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_id").take(pa.array(source, pa.int64())), pa.array(k, pa.int32()), pa.array(m, pa.int32()), pa.array(n, pa.int32()), pa.array(o, pa.int32()), pa.array(t, pa.string())],
                names=["row_id", "piece", "pieces", "n_tokens", "overlap_tokens", "text"],
            )

    out = rows.mapInArrow(run, f"row_id {kind}, piece int, pieces int, n_tokens int, overlap_tokens int, text string")
    return out.withColumnRenamed("row_id", row_id)


def limits(split_limit: DataFrame) -> tuple[int, int]:
    """(max_tokens, overlap_tokens) of the table of one row."""
    r = split_limit.select("max_tokens", "overlap_tokens").first()
    if r is None:
        raise ValueError("split_limit is empty")
    return r.max_tokens, r.overlap_tokens
