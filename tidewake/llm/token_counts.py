"""Token counts by overlap resynchronisation.

A huge text is encoded as chunks that overlap. Two neighbours are spliced at an offset where both
have a pre-token boundary and which the left chunk has decided from characters it can see: from
there on the right chunk's pre-tokens are those of the whole text. Where the overlap holds no such
offset, the left chunk is widened and encoded again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidewake.llm import textbytes as tb
from tidewake.llm.frames import map_arrow, texts
from tidewake.llm.vocab import BytePieces, byte_pieces

CHUNK_CHARS = 16_384
OVERLAP_CHARS = 512
# A boundary is proven if this many characters after it are seen: the longest special string, which
# also covers contractions and the look-ahead of white space.
SEEN_CHARS = 13

_OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])


def count_spliced(pieces: BytePieces, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> int:
    """Tokens of a text from its overlapping chunks."""
    total, n = 0, len(text)
    starts = list(range(0, n, chunk)) or [0]
    left = pieces.boundaries(text[: chunk + overlap])
    left_at, left_end, since = 0, min(n, chunk + overlap), 0
    for start in starts[1:]:
        end = min(n, start + chunk + overlap)
        at, counts = pieces.boundaries(text[start:end])
        width = overlap
        while True:
            proven = left[0] + left_at
            proven = proven[(proven >= start) & ((proven + SEEN_CHARS <= left_end) | (left_end == n))]
            common = np.intersect1d(proven, at + start)
            if len(common) or left_end == n:
                break
            width *= 2
            left_end = min(n, start + width)
            left = pieces.boundaries(text[left_at:left_end])
        if not len(common):
            # The left chunk reaches the end of the text: it counts the rest alone.
            return total + int(left[1][-1]) - since
        splice = int(common[0])
        total += int(left[1][np.searchsorted(left[0], splice - left_at)]) - since
        since = int(counts[np.searchsorted(at, splice - start)])
        if end < left_end:
            end = left_end
            at, counts = pieces.boundaries(text[start:end])
        left, left_at, left_end = (at, counts), start, end
    return total + int(left[1][-1]) - since


def count_tokens(
    docs: DataFrame, vocabulary: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of every text.

    Counts are those of the tokenizer library for the whole text, without special tokens added; special
    strings in a text are taken as the library takes them. A null text is empty and has no tokens. Equal
    rows give equal rows, a null id stays null, other columns are not read, an empty table gives an
    empty table. ``vocabulary`` is a path that every worker can read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = byte_pieces(vocabulary)
        for batch in batches:
            for part in tb.slices(batch, "text"):
                sizes, counts = [], []
                for text in part.column("text").to_pylist():
                    text = text or ""
                    sizes.append(len(text.encode()))
                    counts.append(pieces.count(text) if len(text) <= CHUNK_CHARS else count_spliced(pieces, text))
                n = pa.array(counts, pa.int64())
                over = pa.array([c > limit for c in counts], pa.bool_())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sizes, pa.int64()), n, over], schema=_OUT)

    return map_arrow(texts(docs, id_col, text_col), run, _OUT)
