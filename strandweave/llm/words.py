"""Words of many texts as Arrow arrays: what ASCII white space parts, case and signs as they are."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at once; a longer text is alone.
TOGETHER = 1 << 21


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All texts' words one after the other, and where each text begins (and the last ends)."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    flat, offsets = lists.flatten(), lists.offsets.to_numpy()
    offsets = offsets - offsets[0]
    real = pc.not_equal(flat, "")
    ahead = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    return flat.filter(real), ahead[offsets].astype(np.int64)


def byte_groups(texts: pa.Array):
    """(first, number) of texts that have TOGETHER bytes in all, or are one."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    first, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > first and held + size > TOGETHER:
            yield first, i - first
            first, held = i, 0
        held += size
    if first < len(sizes):
        yield first, len(sizes) - first
