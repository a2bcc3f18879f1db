"""Best-fit packing of documents into training sequences of several permitted lengths.

A text longer than the longest sequence fills whole sequences of its own, and only its rest is packed. Pieces are dealt
by a hash to groups of bounded size, and each group is packed by one task: longest pieces first, each into the open bin
that it leaves least room in; if none has room, a new bin is opened. That is tried once with every size as the one to open,
every bin of a trial is cut down to the cheapest size that holds its contents, and the cheapest trial is kept: long
sizes have fewer sequences to pay for and lose fewer places, short ones cost less in attention.
"""

from __future__ import annotations

from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.columns import without
from quern.session import cut_lineage

#: What a sequence costs however short it is, in words: its start without context, and the work done once a sequence.
PER_SEQUENCE = 256
#: Permitted sequence lengths in words, and what each costs: the fixed part, its length, and a part that grows with its square.
SIZES = {size: PER_SEQUENCE + size * (1 + size / 16384) for size in (512, 1024, 2048, 4096)}
#: Pieces in a group, on average. Packing loses a part of a bin per group, so the groups are large.
GROUP_PIECES = 50_000

WORDS = "[^\\x20\\x09-\\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("bigint")


def cheapest(sizes: Mapping[int, float], length: int) -> int:
    """The permitted size of least cost that holds the length; ties go to the smaller size."""
    return min((cost, size) for size, cost in sizes.items() if size >= length)[1]


def opened(sizes: Mapping[int, float], length: int, largest: int) -> int:
    """The size to open for a piece: the trial's largest, or for a longer piece the cheapest that holds it."""
    return largest if length <= largest else cheapest(sizes, length)


def best_fit(lengths: list[int], sizes: Mapping[int, float], largest: int) -> tuple[list[int], list[int]]:
    """(bin of each length, contents of each bin); lengths come longest first.

    Open bins are kept by their room, and a number whose bits say which rooms occur finds the tightest in one step.
    """
    by_room: dict[int, list[int]] = {}
    rooms = 0
    places, contents, sized = [], [], []
    for length in lengths:
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            at = len(contents)
            room = opened(sizes, length, largest)
            contents.append(0)
            sized.append(room)
        contents[at] += length
        places.append(at)
        room -= length
        if room:
            by_room.setdefault(room, []).append(at)
            rooms |= 1 << room
    return places, contents


def pack(lengths: list[int], sizes: Mapping[int, float]) -> tuple[list[int], list[int]]:
    """(bin of each length, size of each bin) of the cheapest trial, its bins cut down; ties go to the larger size."""
    found = None
    for largest in sorted(sizes, reverse=True):
        places, contents = best_fit(lengths, sizes, largest)
        final = [cheapest(sizes, c) for c in contents]
        cost = sum(sizes[s] for s in final)
        if found is None or cost < found[0]:
            found = (cost, places, final)
    return found[1], found[2]


def split_long(docs: DataFrame, id_col: str, length: Column, largest: int) -> DataFrame:
    """doc_id, piece, start, length: one row per started `largest`; documents without length have no piece."""
    sized = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), length.cast("bigint").alias("n")).where("n > 0")
    pieces = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / largest).cast("bigint")))
    return sized.select("doc_id", "n", pieces.alias("piece")).select(
        "doc_id",
        "piece",
        (F.col("piece") * largest).alias("start"),
        F.least(F.lit(largest).cast("bigint"), F.col("n") - F.col("piece") * largest).alias("length"),
    )


def pack_documents(
    docs: DataFrame, length: Column, id_col: str = "doc_id", sizes: Mapping[int, float] = SIZES,
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, bin_id (text), bin_size, bin_offset.

    Pieces of a document lie `start` into it; a bin is a sequence of bin_size, filled from 0 by its pieces one after
    another. Documents of null or no length are in no bin; rows that repeat are packed as often as they occur; ties of
    length go by id and piece; an empty table gives no rows. Group sizes follow from a hash of id, piece and length, so a
    retried task makes the same bins again.
    """
    pieces = cut_lineage(split_long(docs, id_col, length, max(sizes)))
    groups = max(1, -(-pieces.count() // group_pieces))
    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("doc_id", "piece", "length"), F.lit(groups)))

    def pack_group(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        places, final = pack(pdf["length"].tolist(), sizes)
        group = int(pdf["group"].iloc[0])
        at = pd.Series(places, index=pdf.index)
        return pdf.drop(columns="group").assign(
            bin_id=[f"{group}-{p}" for p in places],
            bin_size=[final[p] for p in places],
            bin_offset=pdf["length"].groupby(at).cumsum() - pdf["length"],
        )

    schema = "doc_id bigint, piece bigint, start bigint, length bigint, bin_id string, bin_size bigint, bin_offset bigint"
    return dealt.groupBy("group").applyInPandas(pack_group, schema)


def with_bins(docs: DataFrame, packed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents' own columns next to their pieces; documents in no bin are left out."""
    keys = packed.withColumnRenamed("doc_id", "__doc")
    kept = without(docs, packed.columns[1:])
    return kept.join(keys, kept[id_col].eqNullSafe(keys["__doc"])).drop("__doc")
