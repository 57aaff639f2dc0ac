"""Filling containers of fixed capacity with documents: first-fit decreasing over a tournament tree of free space.

Documents are dealt at random (by a hash of id and seed) into groups of about ``group_size``; each group is packed on its
own, so a task holds one group's sizes whatever the corpus. Within a group sizes fall, and a tournament tree over the
containers' free space finds the first container that fits in logarithmic time.

Only a document longer than the capacity is split: into full containers and one rest, which is packed like a document.
Documents without tokens (null, blank to the tokenizer) take part with size 0 and go to the first container. Documents
with equal sizes are taken in the order of their ids; equal ids stay separate rows.
"""

from __future__ import annotations

import base64
import functools
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.session import arrow_safe, materialize

#: Ranks of a public byte-level BPE of 50,256 tokens, one "base64 rank" a line.
RANKS_FILE = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how that tokenizer cuts text before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
GROUP = 20_000
#: Capacities that the driver takes; more are an error, none is left out.
MOST_CAPACITIES = 100_000


@functools.lru_cache(2)
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(docs: DataFrame, ranks_file: str = RANKS_FILE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, tokens BIGINT) by a public tokenizer's vocabulary file, over whole texts; null texts have 0.

    The driver's file is sent to the executors, which need no path of their own. Strings of special tokens are ordinary text.
    """
    docs.sparkSession.sparkContext.addFile(ranks_file)
    name = os.path.basename(ranks_file)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = _encoding(SparkFiles.get(name)).encode_ordinary
        for frame in frames:
            yield pd.DataFrame({"doc_id": frame["id"], "tokens": [len(encode(t)) if t else 0 for t in frame["text"]]})

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInPandas(run, "doc_id long, tokens long")


class Tournament:
    """The containers' free space in the leaves, the larger child's in every inner node."""

    def __init__(self, leaves: int, capacity: int) -> None:
        self.size = 1 << max(0, leaves - 1).bit_length()
        self.tree = [capacity] * (2 * self.size)

    def place(self, amount: int) -> int:
        """Takes amount from the first leaf that has it; the leaf's number."""
        tree, node = self.tree, 1
        while node < self.size:
            node *= 2
            if tree[node] < amount:
                node += 1
        leaf = node - self.size
        tree[node] -= amount
        node //= 2
        while node:
            larger = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == larger:
                break
            tree[node] = larger
            node //= 2
        return leaf


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The container of each item; sizes are at most the capacity."""
    order = np.argsort(-sizes, kind="stable")
    tree = Tournament(max(1, len(sizes)), capacity)
    out = np.empty(len(sizes), np.int64)
    for i, size in zip(order.tolist(), sizes[order].tolist()):
        out[i] = tree.place(size)
    return out


def pack(sizes: DataFrame, capacities: DataFrame, group_size: int = GROUP, seed: int = 17) -> DataFrame:
    """(capacity_id, container STRING, doc_id, piece INT, tokens BIGINT): each document's pieces in containers.

    sizes: doc_id, tokens; capacities: capacity_id, capacity_tokens (null or non-positive ones are left out).
    Containers are named by group and number; a group's share of the containers that are not full is what grouping costs.
    """
    limits = [(r.capacity_id, r.capacity_tokens) for r in capacities.where("capacity_tokens > 0").select("capacity_id", "capacity_tokens").limit(MOST_CAPACITIES + 1).collect()]
    if len(limits) > MOST_CAPACITIES:
        raise ValueError(f"more than {MOST_CAPACITIES} capacities")
    total = sizes.count()
    groups = max(1, round(total / group_size))

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["doc_id", "tokens"], kind="stable")
        ids, amounts = frame["doc_id"].to_numpy(), frame["tokens"].to_numpy(np.int64)
        parts = []
        for capacity_id, capacity in limits:
            full, rest = np.divmod(amounts, capacity)
            # an item that fills a container to the brim is not split; a split one leaves full containers and a rest
            pieces = np.maximum(1, full + (rest > 0))
            doc = np.repeat(np.arange(len(ids)), pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            size = np.where(piece < full[doc], capacity, rest[doc])
            box = first_fit_decreasing(size, capacity)
            parts.append(pd.DataFrame({"capacity_id": capacity_id, "container": [f"{key[0]}-{b}" for b in box], "doc_id": ids[doc], "piece": piece.astype(np.int32), "tokens": size}))
        return pd.concat(parts) if parts else arrow_safe(pd.DataFrame(columns=["capacity_id", "container", "doc_id", "piece", "tokens"]))

    dealt = sizes.withColumn("_group", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(groups)))
    return dealt.groupBy("_group").applyInPandas(run, "capacity_id int, container string, doc_id long, piece int, tokens long")


def pack_documents(docs: DataFrame, capacities: DataFrame, ranks_file: str = RANKS_FILE, group_size: int = GROUP) -> DataFrame:
    """``pack`` of the documents' token counts, which are stored first so that no text is read twice."""
    return pack(materialize(token_counts(docs, ranks_file), "token-counts"), capacities, group_size)
