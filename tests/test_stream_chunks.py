"""Streamed chunks against those of the batch flow, whatever the triggers and interruptions."""

import csv
import os
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from vellumark.plans.flows import archive_table
from vellumark.sinks.ledger import DELIVERED
from vellumark.streaming.export import export_stream
from vellumark.streaming.intake import csv_stream, take_files

cloudpickle.register_pickle_by_value(sys.modules[__name__])
ROWS = 12


def accepting(payload, attempt):
    return DELIVERED


def write_files(folder, sizes, start=0, mark=""):
    """Files named and dated in their order."""
    os.makedirs(folder, exist_ok=True)
    number = start
    for k, n in enumerate(sizes):
        path = os.path.join(folder, f"part {start:04}-{k:02}{mark}.csv")
        with open(path, "w", newline="") as f:
            w = csv.writer(f, lineterminator="\n")
            w.writerow(["id", "text"])
            for _ in range(n):
                w.writerow([number, f"a line\nand \"more\" {number}" if number % 3 else "plain"])
                number += 1
        os.utime(path, (1_700_000_000 + number + k, 1_700_000_000 + number + k))
    return number


def chunks(ledger):
    accepted = ledger.where(F.col("status") == DELIVERED)
    return sorted(tuple(r) for r in accepted.select("chunk_id", "rows", "sha").distinct().collect())


@pytest.mark.parametrize("files", [1, 3, 100])
def test_same_chunks_as_the_batch_flow(spark, tmp_path, files):
    src = str(tmp_path / "S_T.csv")
    write_files(src, [5, 0, 30, 1, 12, 12, 7])
    ledger, _ = archive_table(
        spark, src, accepting, str(tmp_path / "work"), "d", "r", "2025-07-09 10:00:00+00", "S", "T", ROWS
    )
    stream = csv_stream(spark, src, ["id", "text"], files)
    got = export_stream(stream, str(tmp_path / f"cp{files}"), str(tmp_path / f"ledger{files}"), accepting, "S", "T", ROWS)
    assert chunks(got) == chunks(ledger)
    assert [c for c, _, _ in chunks(got)] == list(range(6))
    assert got.count() == 6


def test_open_chunks_wait_for_the_next_run_and_survive_failures(spark, tmp_path):
    src, state = str(tmp_path / "S_T.csv"), str(tmp_path / "cp")
    end = write_files(src, [5, 9])
    ledger = str(tmp_path / "ledger")
    calls = []

    def run(transport, close):
        return export_stream(csv_stream(spark, src, ["id", "text"], 1), state, ledger, transport, "S", "T", ROWS, close)

    first = run(accepting, False)
    assert [c[:2] for c in chunks(first)] == [(0, 12)]
    end = write_files(src, [20], end)

    original = csv_stream(spark, src, ["id", "text"], 1)

    class Failing(type(original)):
        def rows(self, batch):
            made = super().rows(batch)
            calls.append(made is None)
            raise RuntimeError("broken off")

    broken = Failing(original.files, original.columns)
    with pytest.raises(Exception):
        export_stream(broken, state, ledger, accepting, "S", "T", ROWS, False)
    assert calls
    write_files(src, [3], end)
    done = run(accepting, True)
    again = run(accepting, True)
    assert chunks(again) == chunks(done) and again.count() == done.count()
    whole, _ = archive_table(spark, src, accepting, str(tmp_path / "work"), "d", "r", "2025-07-09 10:00:00+00", "S", "T", ROWS)
    assert chunks(done) == chunks(whole)
    assert [c[:2] for c in chunks(done)] == [(0, 12), (1, 12), (2, 12), (3, 1)]


def test_a_lost_checkpoint_sends_nothing_twice(spark, tmp_path):
    src = str(tmp_path / "S_T.csv")
    write_files(src, [25, 14])
    sent = [
        export_stream(csv_stream(spark, src, ["id", "text"], files), str(tmp_path / f"cp-{files}"), str(tmp_path / "ledger"), accepting, "S", "T", ROWS).count()
        for files in (1, 2)
    ]
    assert sent == [4, 4]


def test_rows_with_line_breaks_are_taken_whole(spark, tmp_path):
    src = str(tmp_path / "S_T.csv")
    write_files(src, [30, 3], mark="[x]{y}")
    taken = take_files(csv_stream(spark, src, ["id", "text"], 1), str(tmp_path / "cp"), str(tmp_path / "out"))
    assert taken.count() == 33 and taken.where(F.col("text").contains("\n")).count() == 22
