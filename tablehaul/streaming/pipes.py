"""Lines through an external command or a Python callable, one run per partition."""

from __future__ import annotations

import subprocess
from collections.abc import Callable, Collection, Iterable, Iterator
from contextlib import suppress
from threading import Thread

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehaul.functions.columns import the_column
from tablehaul.functions.delimited import NULL_TEXT
from tablehaul.sources.lines import write_lines

# Bounds of a batch of lines.
LINES_PER_BATCH = 10_000
BYTES_PER_BATCH = 16 << 20
READ_BYTES = 1 << 20

Stage = Callable[[Iterator[str]], Iterable[str] | None] | str


def pipe_from(lines: DataFrame, command: str, ok_codes: Collection[int] = (0,)) -> DataFrame:
    """The output lines of a shell command fed with the lines of each partition.

    A command that works line by line gives the same lines however the data is partitioned. An exit code
    outside ``ok_codes`` fails the job; ``grep`` needs ``(0, 1)``, as some partition may have no match.
    """
    raw = _value_column(lines).select(F.col("value").cast("binary"))
    # Bytes both ways: a text may hold bytes that are no UTF-8, and the command may write such.
    return raw.mapInArrow(_through_command(command, frozenset(ok_codes)), "value binary").select(F.col("value").cast("string"))


def pipe_into(
    lines: DataFrame, command: str, path: str, ok_codes: Collection[int] = (0,), mode: str = "overwrite"
) -> None:
    """Write the output lines of a command as a dataset."""
    write_lines(pipe_from(lines, command, ok_codes), path, mode)


def batched(fn: Callable) -> Callable:
    """Mark a stage that takes and yields Arrow arrays of lines instead of single lines."""
    fn.takes_batches = True
    return fn


def associative(fn: Callable) -> Callable:
    """Mark a reducer whose output lines of a key may be reduced again with more lines of the key.

    A job then runs it before the shuffle too, so that a hot key reaches one task as a line for each map partition.
    """
    fn.associative = True
    return fn


def run_stage(lines: DataFrame, stage: Stage) -> DataFrame:
    """Run a command, or a callable from an iterator of lines to lines, over each partition."""
    if isinstance(stage, str):
        return pipe_from(lines, stage)
    return _value_column(lines).mapInArrow(_through_callable(stage), "value string")


def _value_column(lines: DataFrame) -> DataFrame:
    return lines.select(F.coalesce(the_column(lines).cast("string"), F.lit(NULL_TEXT)).alias("value"))


def _through_callable(fn: Callable):
    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in fn(b.column(0) for b in batches) or ():
            yield _batch(out)

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = iter(fn(line for b in batches for line in b.column(0).to_pylist()) or ())
        for chunk in _by_bytes(out):
            yield _batch(pa.array(chunk, pa.string()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from (arrays if getattr(fn, "takes_batches", False) else single)(batches)
        for _ in batches:  # a stage need not read all of its input
            pass

    return run


def _through_command(command: str, ok_codes: frozenset[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        process = subprocess.Popen(command, shell=True, stdin=subprocess.PIPE, stdout=subprocess.PIPE)
        failures: list[BaseException] = []
        feeder = Thread(target=_feed, args=(batches, process.stdin, failures), daemon=True)
        feeder.start()
        try:
            for text in _whole_lines(process.stdout):
                yield _batch(pa.array(text.split(b"\n"), pa.binary()))
            feeder.join()
            code = process.wait()
        finally:
            if process.poll() is None:
                process.kill()
        if failures:
            raise failures[0]
        if code not in ok_codes:
            raise RuntimeError(f"command exited with code {code}: {command}")

    return run


def _feed(batches: Iterator[pa.RecordBatch], stdin, failures: list[BaseException]) -> None:
    try:
        for batch in batches:
            if batch.num_rows:
                for some in _by_bytes(batch.column(0).to_pylist()):
                    stdin.write(b"\n".join(some) + b"\n")
    except BrokenPipeError:  # the command stopped reading, as head does
        for _ in batches:
            pass
    except BaseException as failure:  # noqa: BLE001 - raised again by the task's own thread
        failures.append(failure)
    finally:
        with suppress(BrokenPipeError):
            stdin.close()  # the command waits for this end, whatever happened


def _whole_lines(stdout) -> Iterator[bytes]:
    """Blocks of output cut at line ends, without the last line end."""
    open_line: list[bytes] = []
    while block := stdout.read1(READ_BYTES):
        head, newline, tail = block.rpartition(b"\n")
        if newline:
            yield b"".join([*open_line, head])
            open_line = [tail]
        else:
            open_line.append(block)
    if rest := b"".join(open_line):
        yield rest


def _by_bytes(lines: Iterable) -> Iterator[list]:
    """Lists of lines of a bounded number and a bounded length together; a longer line is alone."""
    some, size = [], 0
    for line in lines:
        if some and (len(some) >= LINES_PER_BATCH or size + len(line) > BYTES_PER_BATCH):
            yield some
            some, size = [], 0
        some.append(line)
        size += len(line)
    if some:
        yield some


def _batch(values: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([values], ["value"])
