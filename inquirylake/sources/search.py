"""Saved result pages of a search as a stream: a chain of pages for each term, followed by their links to the next one."""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

# workers need not have this package: they get what is theirs by value
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NEXT = re.compile(r'<a[^>]*class="[^"]*--next[^"]*"[^>]*>')
NUMBER = re.compile(r'href="[^"]*[?&](?:amp;)?page=(\d+)')


#: Pages that one task reads.
TOGETHER = 8


@dataclass
class Pages(InputPartition):
    term: str
    numbers: list[int]


class SavedSearch(DataSource):
    """term, page, html of the pages below option path, one folder term=T/page=N for each, in any store that pyarrow reads."""

    @classmethod
    def name(cls) -> str:
        return "saved_search"

    def schema(self) -> str:
        return "term string, page long, html string"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return Chain(self.options["path"], int(self.options.get("first", "1")))


class Chain(DataSourceStreamReader):
    """The offset is each term's last page that was read.

    A page that isn't saved yet ends a term's chain for now, as does a page without a link to a next
    one; a later run goes on behind it.  The driver only looks at the links of new pages, each once, and
    follows several terms at a time; executors read the pages, some in each task.
    """

    def __init__(self, path: str, first: int):
        self.path, self.first, self.seen = path, first, None
        self.links: dict[tuple[str, int], int | None] = {}  # of the pages that are saved

    def __getstate__(self) -> dict:
        return self.__dict__ | {"links": {}}  # readers of pages need none

    def _store(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (fs.LocalFileSystem(), self.path)

    def _html(self, term: str, number: int) -> str | None:
        store, root = self._store()
        listed = store.get_file_info(fs.FileSelector(f"{root}/term={term}/page={number}", allow_not_found=True))
        files = sorted(f.path for f in listed if f.is_file and not re.search(r"/[._][^/]*$", f.path))
        if not files:
            return None
        texts = []
        for path in files:
            with store.open_input_stream(path) as stream:
                texts.append(stream.read().decode())
        return "\n".join(texts)

    def _saved(self, term: str, number: int) -> bool:
        """Whether a page is there; the page that it links to, if that link isn't disabled, is then in links."""
        if (term, number) not in self.links:
            html = self._html(term, number)
            if html is None:
                return False
            tag = NEXT.search(html)
            found = tag and "disabled" not in tag[0] and NUMBER.search(tag[0])
            self.links[term, number] = int(found[1]) if found else None
        return True

    def _next(self, term: str, number: int) -> int | None:
        return self.links[term, number] if self._saved(term, number) else None

    def _last(self, term: str, last: int | None) -> int | None:
        """The last page of a term's chain for now."""
        if last is not None and self.links.get((term, last), 0) is None:
            del self.links[term, last]  # it may have got a link since
        number = self.first if last is None else self._next(term, last)
        while number is not None and number > (self.first - 1 if last is None else last) and self._saved(term, number):
            last, number = number, self.links[term, number]
        return last

    def _terms(self) -> list[str]:
        store, root = self._store()
        listed = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
        return sorted(f.base_name.partition("=")[2] for f in listed if f.base_name.startswith("term="))

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        last = dict(self.seen or {})
        terms = self._terms()
        with ThreadPoolExecutor(8) as pool:
            ends = list(pool.map(lambda term: self._last(term, last.get(term)), terms))
        last |= {term: end for term, end in zip(terms, ends, strict=True) if end is not None}
        self.seen = last
        return last

    def partitions(self, start: dict, end: dict) -> list[Pages]:
        self.seen = dict(end)
        out = []
        for term, last in end.items():
            number = self._next(term, start[term]) if term in start else self.first
            numbers = []
            while number is not None and number <= last:
                numbers.append(number)
                number = self._next(term, number)
            out += [Pages(term, numbers[i : i + TOGETHER]) for i in range(0, len(numbers), TOGETHER)]
        return out

    def read(self, partition: Pages) -> Iterator[tuple]:
        for number in partition.numbers:
            yield partition.term, number, self._html(partition.term, number)

    def commit(self, end: dict) -> None:
        self.links = {page: link for page, link in self.links.items() if page[1] >= end.get(page[0], self.first)}


def saved_pages(spark: SparkSession, path: str, first: int = 1):
    """A stream of term, page and html."""
    spark.dataSource.register(SavedSearch)
    return spark.readStream.format("saved_search").option("path", path).option("first", str(first)).load()
