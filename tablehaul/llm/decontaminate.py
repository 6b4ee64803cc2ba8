"""Benchmark decontamination by template canonicalisation, with DataFrame functions only.

Numbers, names and units of a text become typed placeholders that keep their value beside them. Windows of the template
are hash-joined with those of the benchmark, so a question with other numbers or names still matches. Where the
placeholders' values differ, the change must be consistent: within one copy each value of the benchmark's always
stands for the same value of the document's, and no two for the same one.

There are three kinds of windows. In those of ``PLAIN`` a name is one by the words before it. In those of ``CAPITAL`` every
capitalised word is a name, so that names at a sentence's start may differ too. Those of ``EXACT`` have no placeholders:
they find items that are short or dense in numbers, names and units word for word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablehaul.llm.components import rows_by_key, stored, text_key

#: Words in a window, and how many of them must be no placeholders.
WINDOW = 8
LEAST_LITERALS = 5
#: Part of an item's windows that must be found.
LEAST_SHARE = 0.5
#: So many windows of an item are evidence whatever their share: some 19 words in a row.
LEAST_RUN = 12
#: Windows of the benchmark up to this number are broadcast, about 100 bytes each; more are joined by shuffle.
BROADCAST_WINDOWS = 200_000
#: Words that are units after a number.
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg lb lbs ounce ounces ton tons ml cl l liter liters "
    "litre litres gallon gallons second seconds sec minute minutes min hour hours h day days week weeks month months year "
    "years percent dollar dollars euro euros cent cents pound pounds degree degrees meter meters metre metres"
).split()
NUMBER, NAME, UNIT, CAPITALISED, POINT = "\ue000", "\ue001", "\ue002", "\ue003", "\ue00f"
MARKS = NUMBER + NAME + UNIT + CAPITALISED
PLAIN, CAPITAL, EXACT = 1, 2, 3


def template_words(rows: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``words``: the words of a text, lower-cased and without punctuation; a placeholder is its mark, then its value.

    A name is a capitalised word after a lower-case word or a comma; a unit is a word of ``UNITS`` after a number. Other
    capitalised words have the mark ``CAPITALISED``. Each step is a column of its own, so that none is computed twice.
    """
    given = F.coalesce(F.col(text), F.lit(""))
    marked = F.lit(False)
    for mark in MARKS + POINT:
        marked |= F.contains(given, F.lit(mark))
    rows = rows.withColumn("_t", F.when(marked, F.translate(given, MARKS + POINT, " " * 5)).otherwise(given))
    # Patterns begin with a plain sign where they can, so that most positions fail at once.
    rows = rows.withColumn("_t", F.regexp_replace("_t", r" (?<=[\p{Ll},] )(?=\p{Lu}\p{Ll})", f" {NAME}"))
    rows = rows.withColumn("_t", F.lower(F.regexp_replace("_t", rf"\p{{Lu}}(?=\p{{Ll}})(?<![\p{{L}}\p{{N}}{NAME}].)", f"{CAPITALISED}$0")))
    numbers = F.regexp_replace("_t", r"[.,](?<=[0-9].)(?=[0-9])", POINT)
    numbers = F.regexp_replace(numbers, rf"(?<![\p{{L}}0-9{POINT}{NAME}])(?=[0-9])", NUMBER)
    numbers = F.regexp_replace(numbers, rf"(?<=[0-9])( ?){CAPITALISED}?(?=(?:{'|'.join(UNITS)})(?![\p{{L}}0-9]))", f" {UNIT}")
    rows = rows.withColumn("_t", F.when(F.regexp_like("_t", F.lit("[0-9]")), numbers).otherwise(F.col("_t")))
    split = F.split("_t", rf"[^\p{{L}}\p{{N}}{NUMBER}-{POINT}]+")
    return rows.withColumn("words", F.array_remove(split, "")).drop("_t")


def _is_slot(word: Column) -> Column:
    return (word >= F.lit(NUMBER)) & (word < F.lit(POINT))


def _hash_windows(rows: DataFrame, name: str, words: Column, sizes: list[int]) -> DataFrame:
    """Adds ``name`` and a size for each of ``sizes`` (1 to ``WINDOW``): hashes of the windows of so many words.

    Hashes of 8 words come from those of 4, these from those of 2: three sums of neighbours instead of eight.
    """
    step = 1
    rows = rows.withColumn(f"{name}1", words)
    while step < WINDOW:
        rows = rows.withColumn(f"{name}{2 * step}", _joined(f"{name}{step}", f"{name}{step}", step))
        step *= 2
    for size in sizes:
        part = 1 << (size.bit_length() - 1)
        if part < size:  # of its greatest power of two and what is left, which overlaps: 3 words are 2 and 2
            rows = rows.withColumn(f"{name}{size}", _joined(f"{name}{part}", f"{name}{part}", size - part))
    return rows


def _joined(left: str, right: str, distance: int) -> Column:
    n = F.greatest(F.size(right) - distance, F.lit(0))
    return F.zip_with(F.slice(left, F.lit(1), n), F.slice(right, F.lit(distance + 1), n), lambda a, b: F.xxhash64(a, b))


def _windows(rows: DataFrame, exact: list[int]) -> DataFrame:
    """Adds ``slots``, position and value of each placeholder and capitalised word, and the hashes of windows: ``plain8`` and
    ``capital8``, and ``exact`` with each size asked for.
    """
    slots = F.filter(F.transform("words", lambda w, i: F.when(_is_slot(w), F.struct(i.alias("at"), w.alias("value")))), lambda s: s.isNotNull())
    rows = rows.withColumn("slots", slots)
    kind = lambda w: F.substring(w, 1, 1)
    plain = F.transform("words", lambda w: F.xxhash64(F.when(kind(w) == CAPITALISED, F.substring(w, 2, 1 << 30)).when(_is_slot(w), kind(w)).otherwise(w)))
    capital = F.transform("words", lambda w: F.xxhash64(F.lit(CAPITAL), F.when(_is_slot(w), F.translate(kind(w), CAPITALISED, NAME)).otherwise(w)))
    rows = _hash_windows(_hash_windows(rows, "plain", plain, []), "capital", capital, [])
    if exact:
        values = F.transform("words", lambda w: F.xxhash64(F.lit(EXACT), F.translate(w, MARKS, "")))
        rows = _hash_windows(rows, "exact", values, exact)
    return rows


def _own_slots(slots: str, at: str, kind: str | Column) -> Column:
    """The placeholders' values in the window at a position; none for exact windows, as their hash has the values."""
    kind = F.col(kind) if isinstance(kind, str) else kind
    inside = F.filter(slots, lambda s: (s["at"] >= F.col(at)) & (s["at"] < F.col(at) + WINDOW) & ((kind == CAPITAL) | ~s["value"].startswith(CAPITALISED)))
    values = F.transform(inside, lambda s: F.when(kind == CAPITAL, F.translate(s["value"], CAPITALISED, NAME)).otherwise(s["value"]))
    return F.when(kind == EXACT, F.array().cast("array<string>")).otherwise(values)


def _item_windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, kind, size, item_at, hash, item_slots) of all windows that can be evidence.

    ``EXACT`` are all windows of items with a window of too few literals, and the one whole window of an item of fewer than
    ``WINDOW`` words.
    """
    items = _windows(template_words(benchmark.select("item_id", "text")), list(range(1, WINDOW + 1)))
    length = F.size("words")
    exact = F.expr("CASE " + " ".join(f"WHEN size(words) = {n} THEN exact{n}" for n in range(1, WINDOW)) + f" ELSE exact{WINDOW} END")
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), h.alias("hashes")) for k, h in ((PLAIN, F.col("plain8")), (CAPITAL, F.col("capital8")), (EXACT, exact))])
    items = items.select("item_id", "slots", F.least(length, F.lit(WINDOW)).alias("size"), F.explode(kinds).alias("k"))
    # The outer form: else Spark would put a filter on the arrays below the steps, and compute all of them again for it.
    items = items.select("item_id", "slots", "size", "k.kind", F.posexplode_outer("k.hashes").alias("item_at", "hash")).where("hash IS NOT NULL")
    items = items.withColumn("item_slots", _own_slots("slots", "item_at", "kind")).drop("slots")
    literal = F.size("item_slots") <= WINDOW - LEAST_LITERALS
    dense = items.where((F.col("size") < WINDOW) | ((F.col("kind") == PLAIN) & ~literal)).select("item_id").distinct()
    wanted = items.where("kind = 3").join(dense, "item_id", "left_semi")
    return items.where((F.col("kind") != EXACT) & literal).unionByName(wanted)


def find_leaks(docs: DataFrame, benchmark: DataFrame, least_share: float = LEAST_SHARE) -> DataFrame:
    """(doc_id, text_key, item_id, n_windows, n_found, n_exact, share, changed) of documents with a benchmark item in them: at least
    ``least_share`` of its windows, or ``LEAST_RUN`` of them.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text. Windows of a document count for an item if they lie in
    one copy (equal distance of the positions) whose changes are consistent, each once however often it is
    repeated; ``changed`` says that some found window has other values than the item's own. Each kind of windows is judged by itself, and the numbers are those of the kind with the
    greatest share. Windows with fewer than ``LEAST_LITERALS`` words that aren't placeholders count in exact copies only; so
    do items with fewer than ``WINDOW`` words, whose one window is the whole item. Null and empty texts have no window. Very long
    texts are looked at whole. Rows with the same doc_id and text count as one document; ``text_key``, a hash of the text, tells
    others with the same or no doc_id apart. Other columns are not looked at. Without documents or items there are no rows.
    """
    items = stored(_item_windows(benchmark), "item-windows")
    sizes = items.groupBy("item_id", "kind").agg(F.count("*").alias("n_windows"))
    exact = sorted(r["size"] for r in items.where("kind = 3").select("size").distinct().collect())  # at most WINDOW numbers
    few = items.count() <= BROADCAST_WINDOWS
    index = items.drop("size")
    index = F.broadcast(index) if few else index

    found = _windows(template_words(docs.select("doc_id", text_key().alias("text_key"), "text")), exact)
    names = ["plain8", "capital8"] + [f"exact{n}" for n in reversed(exact)]
    # Windows of 8 words of each kind come first: their places follow from the length of one kind.
    found = found.select("doc_id", "text_key", "slots", F.size("plain8").alias("n"), F.posexplode_outer(F.concat(*names)).alias("place", "hash")).join(index, "hash")
    at = F.when(F.col("kind") == EXACT, F.col("place")).otherwise(F.col("place") - (F.col("kind") - 1) * F.col("n"))
    found = found.withColumn("at", at)
    item = ["doc_id", "text_key", "item_id", "kind"]
    found = found.select(*item, "item_at", (F.col("at") - F.col("item_at")).alias("shift"), "item_slots", _own_slots("slots", "at", "kind").alias("doc_slots"))
    # Repeated rows repeat a window: the first of each place stands for all.
    once = found.groupBy(*item, "shift", "item_at").agg(F.min("item_slots").alias("item_slots"), F.min("doc_slots").alias("doc_slots"))
    pair = F.zip_with("item_slots", "doc_slots", lambda a, b: F.struct(a.alias("mine"), b.alias("theirs")))
    same = F.col("item_slots") == F.col("doc_slots")
    copies = once.groupBy(*item, "shift").agg(
        F.collect_list(F.struct("item_at", same.alias("exact"))).alias("windows"), F.array_distinct(F.flatten(F.collect_set(pair))).alias("pairs")
    )
    # One to one: no value of the item's stands for two of the document's, nor two for one.
    mine, theirs = (F.array_distinct(F.col(f"pairs.{side}")) for side in ("mine", "theirs"))
    copies = copies.withColumn("consistent", (F.size(mine) == F.size("pairs")) & (F.size(theirs) == F.size("pairs")))
    counted = F.when(F.col("consistent"), F.col("windows")).otherwise(F.filter("windows", lambda w: w["exact"]))
    # A window counts once, in however many copies it is.
    windows = copies.select(*item, F.explode(counted).alias("w")).groupBy(*item, "w.item_at").agg(F.max("w.exact").alias("exact"))
    leaks = windows.groupBy(*item).agg(F.count("*").alias("n_found"), F.count(F.when(F.col("exact"), 1)).alias("n_exact"))
    leaks = leaks.join(F.broadcast(sizes) if few else sizes, ["item_id", "kind"]).withColumn("share", F.col("n_found") / F.col("n_windows"))
    leaks = leaks.where((F.col("share") >= least_share) | (F.col("n_found") >= LEAST_RUN))
    best = leaks.groupBy("doc_id", "text_key", "item_id").agg(F.max_by(F.struct("n_windows", "n_found", "n_exact", "share"), F.struct("share", -F.col("kind"))).alias("best"))
    return best.select("doc_id", "text_key", "item_id", "best.*", (F.col("best.n_exact") < F.col("best.n_found")).alias("changed"))


def remove_leaks(docs: DataFrame, leaks: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a leak of their own, with all their columns.

    Rows that share a doc_id, or have none, with a row that leaks stay if their own text doesn't leak.
    """
    return rows_by_key(docs, leaks, inside=False)
