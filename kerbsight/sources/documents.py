"""Documents: survey JSON, manifest JSON, gallery HTML.

Formatted byte for byte: sorted keys, two spaces, non-ASCII as it is, one newline at the end.  Rows become
text in the tasks that hold them.  The text of one document reaches the driver in order, a partition at a time;
a survey of any length is a folder of documents (``write_survey``), written by the tasks as pictures are.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..operators import preview, summary
from ..operators.survey import Target
from . import files

STYLE = "body{font:15px sans-serif;margin:2em}.grid{display:flex;flex-wrap:wrap;gap:1em}figure{margin:0;width:20em;border:1px solid #ccc}img,.missing{width:100%;height:13em;object-fit:cover}"


#: A document of a survey in parts ends once its items have so many characters.
PART_CHARS = 4 << 20


def to_text(document: dict) -> str:
    return json.dumps(document, ensure_ascii=False, indent=2, sort_keys=True) + "\n"


def _item_texts(batches: Iterable[pa.RecordBatch], dropped: tuple[str, ...] = ()) -> Iterator[str]:
    """Each row as the text of an item of a list.  dropped: keys left out where null."""
    for batch in batches:
        for i in range(0, batch.num_rows, 1024):
            for r in batch.slice(i, 1024).to_pylist():
                found = {k: v for k, v in r.items() if not (v is None and k in dropped)}
                yield "    " + to_text(found)[:-1].replace("\n", "\n    ")


def _row_texts(rows: DataFrame, dropped: tuple[str, ...] = ()) -> Iterator[str]:
    """The items' texts at the driver, in the order of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                yield pa.RecordBatch.from_arrays([pa.array(_item_texts([batch.slice(i, 1024)], dropped), pa.string())], names=["text"])

    return (r.text for r in rows.mapInArrow(run, "text string").toLocalIterator())


def _with_lists(document: dict, lists: dict[str, Iterable[str]]) -> Iterator[str]:
    """The text of a document whose lists of rows are told one item at a time.  They stand in it as empty
    lists, and no text of another value has a line feed, so each is found at the begin of its line."""
    text = to_text(document | dict.fromkeys(lists, ()))
    for key in sorted(lists):
        before, text = text.split(f'\n  "{key}": []', 1)
        yield before
        empty = True
        for item in lists[key]:
            yield f'\n  "{key}": [\n{item}' if empty else f",\n{item}"
            empty = False
        yield f'\n  "{key}": []' if empty else "\n  ]"
    yield text


def survey_head(rows: DataFrame, target: Target, *, endpoint: str = schemas.ENDPOINT, provider: str = schemas.PROVIDER, license_id: str | None = None, license_url: str | None = None) -> dict:
    """A survey document without its lists; rows: candidates."""
    total = summary.overall(rows).first().asDict()
    classes = {r["view_class"]: r["candidate_count"] for r in summary.view_class_counts(rows).collect()}
    return {
        "schema_version": schemas.SURVEY_VERSION,
        "provider": provider,
        "endpoint": endpoint,
        "target": {"latitude": target.latitude, "longitude": target.longitude, "radius_m": target.radius_m},
        "license": {"id": license_id, "url": license_url},
        "candidate_count": total["candidate_count"],
        "summary": {
            "sequence_count": total["sequence_count"],
            "unsequenced_count": total["unsequenced_count"],
            "view_class_counts": classes,
            "target_in_fov_counts": {k: total[f"fov_{k}"] for k in ("true", "false", "unknown")},
        },
    }


def survey_document(rows: DataFrame, target: Target, **named) -> dict:
    """The survey as one object, for results of a known size; rows: ordered candidates."""
    lists = {"sequences": [r.asDict() for r in summary.ordered_sequences(rows).collect()], "candidates": [r.asDict() for r in rows.collect()]}
    return survey_head(rows, target, **named) | lists


def survey_text(rows: DataFrame, head: dict) -> Iterator[str]:
    """The text of the survey document of ordered candidates and their head, in pieces."""
    return _with_lists(head, {"candidates": _row_texts(rows), "sequences": _row_texts(summary.ordered_sequences(rows))})


def _part_files(rows: DataFrame, key: str) -> DataFrame:
    """(name, content): survey documents that list the rows under key, a share each; their names ascend in the order of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        items, chars = [], 0

        def told() -> pa.RecordBatch:
            content = "".join(_with_lists({"candidates": (), "sequences": ()}, {key: items})).encode("utf-8")
            return pa.RecordBatch.from_pydict({"name": [f"{key}-{part:06d}-{n:06d}.json"], "content": pa.array([content], pa.binary())})

        for text in _item_texts(batches):
            items.append(text)
            chars += len(text)
            if chars >= PART_CHARS:
                yield told()
                items, chars, n = [], 0, n + 1
        if items:
            yield told()

    return rows.mapInArrow(run, "name string, content binary")


def write_survey(rows: DataFrame, head: dict, folder: str) -> None:
    """A survey of ordered candidates as a folder of survey documents, for any number of rows: the head with empty
    lists, and the lists in parts of bounded length, written by the tasks that hold them.  Rows are read several times:
    store them.  The head is written last."""
    rows.sparkSession.dataSource.register(files.FileSink)
    for key, listed in (("candidates", rows), ("sequences", summary.ordered_sequences(rows))):
        _part_files(listed, key).write.format("named_files").mode("append").save(folder)
    write_text(f"{folder}/head.json", to_text(head | {"candidates": (), "sequences": ()}))


def write_text(path: str, text: str | Iterable[str]) -> None:
    """Writes beside the path first (a path, or a URI of a shared store), so a job that fails leaves an older
    document as it was."""
    fs, place = files.file_system(path)
    folder, _, name = place.rpartition("/")
    pending = f"{folder or '.'}/.{name}.pending"
    fs.create_dir(folder or ".", recursive=True)
    try:
        with fs.open_output_stream(pending) as f:
            for piece in [text] if isinstance(text, str) else text:
                f.write(piece.encode("utf-8"))
    except BaseException:
        fs.delete_file(pending)
        raise
    fs.move(pending, place)


def write_preview(results: DataFrame, folder: str, *, source: str, max_items: int, per_sequence: int) -> dict:
    """Thumbnails, manifest.json and index.html of a judged shortlist; the manifest without its items.
    results are read several times: store or cache them if they come from the network."""
    spark = results.sparkSession
    spark.dataSource.register(files.FileSink)
    done = results.where("status = 'downloaded'").select(F.col("local_file").alias("name"), "content")
    done.write.format("named_files").mode("append").save(folder)
    told = results.drop("content").orderBy("rank")
    manifest = {"schema_version": schemas.MANIFEST_VERSION, "source_survey": source, **preview.counts(results).first().asDict(), "max_items": max_items, "per_sequence": per_sequence}
    items = _row_texts(told, ("error", "thumbnail_url", "local_file", "bytes", "content_type"))
    write_text(f"{folder}/manifest.json", _with_lists(manifest, {"items": items}))
    write_text(f"{folder}/index.html", _page(r.card for r in preview.cards(results).orderBy("rank").toLocalIterator()))
    return manifest


def _page(cards: Iterable[str]) -> Iterator[str]:
    yield f'<!doctype html>\n<html lang="en"><head><meta charset="utf-8"><title>Shortlisted views</title><style>{STYLE}</style></head>\n<body><h1>Shortlisted views</h1><div class="grid">'
    for k, card in enumerate(cards):
        yield "\n" * bool(k) + card
    yield "</div></body></html>\n"
