"""Exact duplicates of texts by a tree merge of sorted digest runs.

Every partition makes a run: its digests in order, each once, with the smallest identifier
and the number of its rows.  Partitions (*nodes*) then exchange runs in binomial rounds: the
nodes that differ in one digit of their number split the digests they hold among them, by
the digest's own digit for that round, and each merges the runs that it is sent, several at
once, keeping the smallest identifier of equal entries.  After the last round a node's
number is spelled by the digits of its digests, so equal digests have met wherever they
started, and no node holds more than its share of the distinct digests.

A digest that fills a third of the table is one entry a run, so at most ``fan_in`` entries
of it meet at a node in a round.  The answers go back to the runs they came from, and each
run answers its own rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugewell.llm.common import dropped, stored

FAN_IN = 8
#: An entry's digest, and what verifies that two entries of one digest are of one text.
SAME = ("digest", "n_bytes", "proof")


def radix(parts: int, fan_in: int = FAN_IN) -> tuple[int, int]:
    """(digits' base, rounds): base ^ rounds nodes, ``parts`` at least, base at most ``fan_in``."""
    rounds = 1
    while fan_in**rounds < parts:
        rounds += 1
    base = 2
    while base**rounds < parts:
        base += 1
    return base, rounds


def _normalised():
    return F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " ")


def digests(docs: DataFrame, nodes: int) -> DataFrame:
    """doc_id, digest (SHA-256), n_bytes and proof (a second hash) of the normalised text, row (a number of its own), node."""
    text = docs.select("doc_id", _normalised().alias("normalised"))
    row = F.monotonically_increasing_id()
    return text.select(
        "doc_id",
        F.unhex(F.sha2("normalised", 256)).alias("digest"),
        F.octet_length("normalised").cast("long").alias("n_bytes"),
        F.xxhash64("normalised").alias("proof"),
        row.alias("row"),
        F.pmod(F.spark_partition_id(), F.lit(nodes)).cast("int").alias("node"),
    )


def merged(entries: DataFrame) -> DataFrame:
    """Merge the sorted runs in each partition: equal entries of a node are one, under the smallest identifier.

    Identifiers go by doc_id, rows without one last, then by row.  The merge holds one batch
    and one open entry.
    """
    order = ["node", *SAME, F.col("doc_id").asc_nulls_last(), "row"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_entry = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if open_entry is not None:
                batch = pa.Table.from_batches([open_entry, batch]).combine_chunks().to_batches()[0]
            new = np.zeros(batch.num_rows, bool)
            new[0] = True
            for name in ("node", *SAME):
                column = batch.column(name)
                differs = pc.not_equal(column.slice(1), column.slice(0, len(column) - 1))
                new[1:] |= differs.to_numpy(zero_copy_only=False)
            first = np.flatnonzero(new)
            counts = np.add.reduceat(batch.column("n").to_numpy(), first)
            found = batch.take(pa.array(first))
            found = found.set_column(found.schema.get_field_index("n"), found.schema.field("n"), pa.array(counts))
            yield found.slice(0, len(first) - 1)
            open_entry = found.slice(len(first) - 1)
        if open_entry is not None:
            yield open_entry

    return entries.sortWithinPartitions(*order).mapInArrow(run, entries.schema)


def exchanged(runs: DataFrame, base: int, rounds: int) -> DataFrame:
    """Entries of all runs after the rounds: one per text, at the node that its digest spells."""
    # 52 bits of the digest spell its node, most significant digit first
    lead = F.conv(F.substring(F.hex("digest"), 1, 13), 16, 10).cast("long")
    for i in range(rounds):
        place = base**i
        digit = F.pmod(F.floor(lead / F.lit(place)), F.lit(base))
        held = F.pmod(F.floor(F.col("node") / F.lit(place)), F.lit(base))
        to = (F.col("node") + (digit - held) * F.lit(place)).cast("int")
        runs = merged(runs.withColumn("node", to).repartitionById(base**rounds, F.col("node")))
    return runs


def exact_groups(docs: DataFrame, fan_in: int = FAN_IN, parts: int | None = None) -> DataFrame:
    """Rows of equal text: doc_id, keep_id, group_size, kept, text_sha256; one row per row of ``docs``.

    Texts are equal when they are after every run of white space (space, U+0009 to U+000D)
    has become one space; NULL is the empty text.  ``keep_id`` is the smallest doc_id of the
    group, and its row is ``kept``.  Rows without an id come last: they stay only where the
    whole group has none, and ``keep_id`` is NULL then.  Of rows that share that id one is
    kept (which one is arbitrary: their results do not differ otherwise).  An empty table
    gives no rows; other columns are not read.
    """
    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    base, rounds = radix(parts, fan_in)
    rows = stored(digests(docs, base**rounds), "digests")
    runs = stored(merged(rows.withColumn("n", F.lit(1).cast("long"))), "digest-runs")
    groups = exchanged(runs, base, rounds).where("n > 1")
    groups = groups.select(*SAME, F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"), F.col("n").alias("group_size"))
    # back to the runs: an entry per run at most, so a common text is spread like its rows
    answers = stored(runs.select("node", *SAME).distinct().join(groups, list(SAME)), "digest-answers")
    dropped(runs)
    out = rows.join(answers, ["node", *SAME], "left")
    return out.select(
        "doc_id",
        F.when(F.col("keep_row").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.coalesce("keep_row", "row") == F.col("row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
