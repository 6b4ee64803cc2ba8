"""Moving and reshaping tables with Spark: delimited text, extracts, SQL scripts, line map/reduce."""

import sys

from pyspark import cloudpickle

from tablehaul.functions.columns import column_list
from tablehaul.functions.text import line_record, tokenize
from tablehaul.operators.aggregate import reduce_by_key, word_count
from tablehaul.operators.extract import extract, result_columns
from tablehaul.operators.runs import run_sum
from tablehaul.operators.stats import table_properties, table_stats
from tablehaul.plans.script import render, resolve_variables, run_script, sql
from tablehaul.sources.delimited import dump, format_lines, parse_lines, read_delimited
from tablehaul.sources.csv import extract_csv
from tablehaul.sources.formats import result_lines, to_long_form
from tablehaul.sources.lines import numbered_lines, positioned_lines, read_lines, read_sequence_lines, write_lines
from tablehaul.sources.tables import load_partition, load_table
from tablehaul.streaming.mapreduce import map_reduce, named
from tablehaul.streaming.pipes import associative, batched, pipe_from, pipe_into
from tablehaul.streaming.stages import sum_adjacent, words

__all__ = [
    "associative", "batched", "column_list", "dump", "extract", "extract_csv", "format_lines",
    "line_record", "load_partition", "load_table", "map_reduce", "named", "numbered_lines", "parse_lines", "pipe_from",
    "pipe_into", "positioned_lines", "read_delimited", "read_lines", "read_sequence_lines", "reduce_by_key", "render",
    "resolve_variables", "result_columns", "result_lines", "run_script", "run_sum", "sql",
    "sum_adjacent", "table_properties", "table_stats", "to_long_form", "tokenize", "word_count", "words", "write_lines",
]

# Functions that run inside tasks travel with the job, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
