"""Line deduplication by winnowing over line hashes.

A document is the sequence of its lines that hold a word.  A *gram* is the
shortest run of lines from a line on with ``GRAM`` words; a *window* is the
shortest run with ``RUN`` words.  Of the grams inside each window the one with
the smallest hash (the last of equals) is a fingerprint.  Two places that share
a run of at least ``RUN`` words share a whole window, hence a fingerprint: that
is the guarantee of winnowing, here in words instead of line counts, so one
long line is as good as many short ones.

Every fingerprint is joined with its first occurrence (by id, then place in
the input, then line), the match is extended both ways as far as the lines
agree, and the run is deleted at the later place.  The first occurrence may share
less than a later one does.  So the windows of a later fingerprint that its run
does not cover are joined again, by the hash of the whole window, with the first
place of an equal window, and deleted where that is another place.  Every window of
a repeated run has an equal one earlier, so each run of ``RUN`` words that occurred
anywhere before goes, whatever other documents share with it.  Repeated runs of
``GRAM`` to ``RUN`` words go if a fingerprint falls on them; shorter ones stay.  A
line is deleted only if an equal line stands earlier, so the first copy stays.

A fingerprint that a third of all documents share is joined with one row, not
with its other occurrences; both sides of that join are read from files, so
adaptive execution splits it.  What is grouped is one document's matches.

Edge cases: null and empty texts and documents of fewer than ``RUN`` words are
left alone; blank lines are never compared and stay; null ids come last in
order; repeated rows are copies; extra columns are kept.  Lines that become
neighbours by a deletion are not compared again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardloom.llm.common import broadcast_within, python_ready, small_batches, stage

#: Every repeated run of so many words is found.
RUN = 48
#: Words of a fingerprint: no shorter run is deleted.
GRAM = 40


def content_lines(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hash and word count of each line that holds a word, white space at its ends apart."""
    lines = [x for x in map(bytes.strip, text.encode().split(b"\n")) if x] if text else []
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, lines), np.uint64, len(lines)).view(np.int64)
    return hashes, np.fromiter((len(x.split()) for x in lines), np.int32, len(lines))


def _ends(words: np.ndarray, least: int) -> np.ndarray:
    """End (exclusive) of the shortest run from each line on with ``least`` words; past the last line if none."""
    total = np.concatenate([[0], np.cumsum(words)])
    return np.searchsorted(total, total[:-1] + least, "left")


def fingerprints(hashes: np.ndarray, words: np.ndarray, run: int = RUN, gram: int = GRAM) -> list[tuple[int, int, int, int]]:
    """(gram hash, first line, first and last window that select it, each by its first line) of the selected grams."""
    n = len(hashes)
    gram_end, run_end = _ends(words, gram), _ends(words, run)
    data, out, last = hashes.tobytes(), [], -1
    value = [xxhash.xxh3_64_intdigest(data[8 * i : 8 * e]) if e <= n else -1 for i, e in enumerate(gram_end)]
    stop, held = 0, []  # held: grams of the window with rising hashes, as a queue of minima
    head = 0
    for i in range(n):
        if run_end[i] > n:
            break
        while stop < n and gram_end[stop] <= run_end[i]:
            while len(held) > head and value[held[-1]] >= value[stop]:
                held.pop()
            held.append(stop)
            stop += 1
        while held[head] < i:
            head += 1
        if held[head] != last:
            last = held[head]
            out.append((int(np.uint64(value[last]).view(np.int64)), last, i, i))
        else:
            out[-1] = (*out[-1][:3], i)
    return out


def _sketch(run_words: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("mark", "pos", "lo", "hi")
        kind = pa.list_(pa.struct([("mark", pa.int64()), *((n, pa.int32()) for n in names[1:])]))
        for batch in batches:
            for part in small_batches(batch, 1):
                lines = [content_lines(t) for t in part.column(1).to_pylist()]
                marks = [[dict(zip(names, f, strict=True)) for f in fingerprints(h, w, run_words, gram)] for h, w in lines]
                cols = [part.column(0), pa.array([h.tobytes() for h, _ in lines], pa.binary())]
                cols += [pa.array([w.tobytes() for _, w in lines], pa.binary()), pa.array(marks, kind)]
                yield pa.RecordBatch.from_arrays(cols, names=["rid", "hashes", "words", "marks"])

    return run


def extend(a: np.ndarray, b: np.ndarray, pos: int, pos0: int) -> tuple[int, int]:
    """The run around a[pos] that agrees with ``b`` around b[pos0]."""
    back = min(pos, pos0)
    same = a[pos - back : pos][::-1] == b[pos0 - back : pos0][::-1]
    start = pos - (back if same.all() else int(np.argmin(same)))
    ahead = min(len(a) - pos, len(b) - pos0)
    same = a[pos : pos + ahead] == b[pos0 : pos0 + ahead]
    return start, pos + (ahead if same.all() else int(np.argmin(same)))


def _extend(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        for batch in batches:
            for part in small_batches(batch, 2, 8 << 20):
                out = []
                for a, w, b, matches in zip(*(part.column(i).to_pylist() for i in (1, 2, 3, 4)), strict=True):
                    a, b, w = np.frombuffer(a, np.int64), np.frombuffer(b, np.int64), np.frombuffer(w, np.int32)
                    total, runs, covered = np.concatenate([[0], np.cumsum(w)]), [], {}
                    for m in sorted(matches, key=lambda m: (m["pos"], m["pos0"])):
                        shift = m["pos"] - m["pos0"]
                        if covered.get(shift, -1) > m["pos"]:
                            continue  # inside the run found before on this diagonal
                        start, stop = extend(a, b, m["pos"], m["pos0"])
                        covered[shift] = stop
                        if total[stop] - total[start] >= least:  # else equal hashes of unequal grams
                            runs.append({"start": start, "stop": stop})
                    out.append(runs)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out, kind)], names=["rid", "runs"])

    return run


def _windows(run_words: int):
    """(rid, hashes, words, [(mark, lo, hi)], runs) -> the windows that these fingerprints
    stand for and that no run covers: mark, hash of the window, first line, end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_batches(batch, 1, 8 << 20):
                out = []
                for rid, a, w, marks, runs in zip(*(part.column(i).to_pylist() for i in range(5)), strict=True):
                    ends = _ends(words := np.frombuffer(w, np.int32), run_words)
                    held = np.zeros(len(words) + 1, np.int64)
                    for r in runs or ():
                        held[r["start"] : r["stop"]] = 1
                    held = np.concatenate([[0], np.cumsum(held)])
                    for m in marks:
                        for s in range(m["lo"], m["hi"] + 1):
                            e = int(ends[s])
                            if held[e] - held[s] < e - s:
                                out.append((rid, m["mark"], xxhash.xxh3_128_digest(a[8 * s : 8 * e]), s, e))
                cols = zip(*out, strict=True) if out else [()] * 5
                kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32())
                arrays = [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=["rid", "mark", "same", "start", "stop"])

    return run


def _uncovered(lines: DataFrame, marks: DataFrame, later: DataFrame, runs: DataFrame, run: int) -> DataFrame:
    """(rid, start, stop) of the windows of ``later`` fingerprints outside ``runs`` that have an equal window before them."""
    kind = "rid long, mark long, same binary, start int, stop int"
    own = lines.select("rid", "hashes", "words")

    def windows(places: DataFrame, covered: DataFrame | None) -> DataFrame:
        per = places.groupBy("rid").agg(F.collect_list(F.struct("mark", "lo", "hi")).alias("marks")).join(own, "rid")
        spans = F.lit(None).cast("array<struct<start:int,stop:int>>").alias("runs")
        per = per.join(covered, "rid", "left") if covered is not None else per.select("*", spans)
        return per.select("rid", "hashes", "words", "marks", "runs").mapInArrow(_windows(run), kind)

    wanted = stage(windows(later, runs), "windows")
    asked = wanted.select("mark").distinct()
    places = stage(windows(marks.join(asked, "mark", "left_semi"), None), "places")
    place = F.struct(F.col("id").isNull().alias("last"), "id", "rid", "start")
    firsts = places.join(marks.select("rid", "id").distinct(), "rid").groupBy("same").agg(F.min(place).alias("first"))
    firsts = firsts.select("same", F.col("first.rid").alias("rid0"), F.col("first.start").alias("start0"))
    found = wanted.join(firsts, "same").where("not (rid = rid0 and start = start0)")
    return found.select("rid", "start", "stop").distinct()


def _delete(at: int, runs: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small_batches(batch, at):
                texts, lines, gone, words = [], [], [], []
                for text, spans in zip(part.column(at).to_pylist(), part.column(runs).to_pylist(), strict=True):
                    rows = text.split("\n") if text else []
                    place = [i for i, x in enumerate(rows) if x.encode().strip()]
                    drop = {place[i] for s in spans or () for i in range(s["start"], s["stop"])}
                    texts.append("\n".join(x for i, x in enumerate(rows) if i not in drop) if drop else text)
                    lines.append(len(place))
                    gone.append(len(drop))
                    words.append(sum(len(rows[i].encode().split()) for i in drop))
                cols = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(part.columns) if i != runs]
                cols += [pa.array(x, pa.int64()) for x in (lines, gone, words)]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


REPORT = ("__ll_lines", "__ll_deleted", "__ll_words")


def dedup_report(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", run: int = RUN, gram: int = GRAM
) -> DataFrame:
    """``docs`` with deleted runs taken out of ``text``, plus ``REPORT``: the
    lines that hold a word, how many of them were deleted, and their words."""
    if not 0 < gram <= run:
        raise ValueError("gram must be positive and at most run")
    python_ready(docs.sparkSession)
    cols = docs.columns
    held = stage(docs.withColumn("__ll_rid", F.monotonically_increasing_id()), "documents")
    texts = held.select(F.col("__ll_rid").alias("rid"), F.col(text).alias("text"))
    sketch = "rid long, hashes binary, words binary, marks array<struct<mark:long,pos:int,lo:int,hi:int>>"
    lines = stage(texts.mapInArrow(_sketch(run, gram), sketch), "lines")

    ids = held.select(F.col("__ll_rid").alias("rid"), F.col(doc_id).alias("id"))
    marks = lines.select("rid", F.explode("marks").alias("m")).select("rid", "m.*")
    marks = stage(marks.join(ids, "rid"), "fingerprints")
    place = F.struct(F.col("id").isNull().alias("last"), "id", "rid", "pos")
    firsts = marks.groupBy("mark").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    firsts = stage(firsts.select("mark", F.col("first.rid").alias("rid0"), F.col("first.pos").alias("pos0")), "first-marks")
    later = marks.join(firsts, "mark").where("not (rid = rid0 and pos = pos0)")
    later = stage(later.select("rid", "mark", "lo", "hi", "rid0", "pos", "pos0"), "later-marks")
    pairs = later.groupBy("rid", "rid0").agg(F.collect_list(F.struct("pos", "pos0")).alias("matches"))
    pairs = stage(pairs, "matches")
    own = lines.select("rid", F.col("hashes").alias("a"), F.col("words").alias("w"))
    other = lines.select(F.col("rid").alias("rid0"), F.col("hashes").alias("b"))
    both = pairs.join(own, "rid").join(other, "rid0").select("rid", "a", "w", "b", "matches")
    runs = both.mapInArrow(_extend(gram), "rid long, runs array<struct<start:int,stop:int>>")
    runs = runs.where(F.size("runs") > 0).groupBy("rid").agg(F.flatten(F.collect_list("runs")).alias("__ll_runs"))
    runs = stage(runs, "runs")
    whole = _uncovered(lines, marks, later, runs.withColumnRenamed("__ll_runs", "runs"), run)
    whole = whole.groupBy("rid").agg(F.collect_list(F.struct("start", "stop")).alias("__ll_runs"))
    runs = runs.unionByName(whole).groupBy(F.col("rid").alias("__ll_rid")).agg(F.flatten(F.collect_list("__ll_runs")).alias("__ll_runs"))
    runs = stage(runs, "all-runs")

    runs = broadcast_within(runs, F.size("__ll_runs") * 16 + 32)  # within the bound, texts are not shuffled
    joined = held.join(runs, "__ll_rid", "left").select(*cols, "__ll_runs")
    names = [*cols, *REPORT]
    schema = T.StructType([*docs.schema.fields, *(T.StructField(c, T.LongType()) for c in REPORT)])
    return joined.mapInArrow(_delete(cols.index(text), len(cols), names), schema)


def deduplicate(docs: DataFrame, *, drop_emptied: bool = True, **options) -> DataFrame:
    """``docs`` without later repeated runs.  A document that loses its every
    line with a word is dropped unless ``drop_emptied`` is false."""
    out = dedup_report(docs, **options)
    if drop_emptied:
        lines, deleted = F.col(REPORT[0]), F.col(REPORT[1])
        out = out.where((deleted == 0) | (deleted < lines))
    return out.select(*docs.columns)
