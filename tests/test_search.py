"""Saved result pages as a stream: three terms, and a run that goes on behind the last page."""

from inquirylake.sources.search import saved_pages


def save(root, term, number, following, disabled=False):
    folder = root / f"term={term}" / f"page={number}"
    folder.mkdir(parents=True)
    mark = " item--disabled" if disabled else ""
    tag = f'<a class="item--next{mark}" href="/s.html?x=1&amp;page={following}">' if following else ""
    (folder / "page.html").write_text(f"<html>{term}-{number} ü{tag}</html>")


def test_pages_are_followed_and_resumed(spark, tmp_path):
    root = tmp_path / "pages"
    for number in (1, 2, 3):
        save(root, "18", number, number + 1 if number < 3 else None)
    save(root, "17", 1, 2)  # the next one isn't saved yet
    save(root, "16", 1, 2, disabled=True)
    save(root, "16", 2, None)  # nothing leads here

    def run():
        stream = saved_pages(spark, str(root)).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "mark")).trigger(availableNow=True).start()
        stream.awaitTermination()
        return sorted((r["term"], r["page"], r["html"][6:12].split("-")[0]) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    first = [("16", 1, "16"), ("17", 1, "17"), ("18", 1, "18"), ("18", 2, "18"), ("18", 3, "18")]
    assert run() == first
    save(root, "17", 2, 3)
    save(root, "17", 3, None)
    save(root, "15", 1, None)
    assert run() == sorted([*first, ("17", 2, "17"), ("17", 3, "17"), ("15", 1, "15")])
    assert run() == sorted([*first, ("17", 2, "17"), ("17", 3, "17"), ("15", 1, "15")])


def test_the_driver_reads_each_page_once(spark, tmp_path, monkeypatch):
    from inquirylake.sources.search import Chain

    for number in range(1, 20):
        save(tmp_path, "18", number, number + 1)
    read, chain = [], Chain(str(tmp_path), 1)
    html = Chain._html
    monkeypatch.setattr(Chain, "_html", lambda self, term, number: read.append(number) or html(self, term, number))
    end = chain.latestOffset()
    parts = chain.partitions(chain.initialOffset(), end)
    assert end == {"18": 19} and [n for p in parts for n in p.numbers] == list(range(1, 20)) and len(parts) == 3
    assert read == list(range(1, 21))  # the last one isn't saved yet
