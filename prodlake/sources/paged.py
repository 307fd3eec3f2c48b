"""S-05, S-06: a document API read page by page as a stream that resumes where it stopped.

The offset of the stream is the token of the next page, so a restart goes on after the last page whose batch was committed,
and a finished chain is not asked again. Pages are objects of a folder on any file system that pyarrow knows by its URI
(recorded responses; a live API answers the same questions); a page is bounded by the API and passes the driver alone.

A page must be an object with a list of documents that have names; anything else stops the stream with the page's name.
An object `abort` in the folder stops it before the next page; taken away, a restart goes on from there.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.types import StructType

from prodlake.sources.readers import decode_value

FIRST = "first"


class ShapeError(ValueError):
    """A page that is no page of documents."""


class Aborted(RuntimeError):
    """The reader was asked to stop."""


def checked(page: object, name: str) -> dict:
    """The page, if it has the shape of one."""
    documents = page.get("documents", []) if isinstance(page, dict) else None
    if not isinstance(documents, list) or not all(isinstance(d, dict) and isinstance(d.get("name"), str) and isinstance(d.get("fields", {}), dict) for d in documents):
        raise ShapeError(f"page {name} is not an object with a list of named documents")
    token = page.get("nextPageToken")
    if token is not None and not isinstance(token, str):
        raise ShapeError(f"page {name}: its next token is no text")
    return page


class PageChain(SimpleDataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.uri = options["path"]
        self.pages = int(options.get("pagesPerBatch", "1"))

    def _open(self, name: str) -> dict:
        files, folder = fs.FileSystem.from_uri(self.uri)
        if files.get_file_info(f"{folder}/abort").type != fs.FileType.NotFound:
            raise Aborted(f"stopped before page {name}")
        with files.open_input_stream(f"{folder}/{name}.json") as page:
            try:
                body = json.loads(page.read())
            except ValueError as e:
                raise ShapeError(f"page {name} is not JSON") from e
        return checked(body, name)

    def initialOffset(self) -> dict:
        return {"token": FIRST, "pages": 0}

    def _walk(self, start: dict, stop) -> tuple[list[tuple], dict]:
        rows, token, pages = [], start["token"], start["pages"]
        while token and not stop(pages):
            page = self._open(token)
            for d in page.get("documents", []):
                values = {k: decode_value(v) for k, v in d.get("fields", {}).items()}
                rows.append((d["name"].rsplit("/", 1)[-1], json.dumps(values, ensure_ascii=False, sort_keys=True), token))
            token, pages = page.get("nextPageToken") or "", pages + 1
        return rows, {"token": token, "pages": pages}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        rows, end = self._walk(start, lambda pages: pages >= start["pages"] + self.pages)
        return iter(rows), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return iter(self._walk(start, lambda pages: pages >= end["pages"])[0])


class DocumentPages(DataSource):
    """Format `document_pages`: options path (a folder's URI) and pagesPerBatch."""

    @classmethod
    def name(cls) -> str:
        return "document_pages"

    def schema(self) -> str:
        return "document_id string, fields string, page string"

    def simpleStreamReader(self, schema: StructType) -> SimpleDataSourceStreamReader:
        return PageChain(self.options)
