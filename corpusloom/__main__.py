"""Command line: ``python -m corpusloom word-count|split-sweep|metadata|similarity|network``."""

from __future__ import annotations

import argparse

from corpusloom.plans import influence, metadata, similarity, word_count
from corpusloom.session import get_session
from corpusloom.sources.chunks import book_outcomes, file_listing, unread
from corpusloom.sources.files import books


def main(arguments: list[str] | None = None) -> None:
    options = _parser().parse_args(arguments)
    spark = get_session(f"corpusloom {options.job}")
    options.run(spark, options)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="corpusloom")
    jobs = parser.add_subparsers(dest="job", required=True)

    counted = jobs.add_parser("word-count", help="count words of text files")
    counted.add_argument("source")
    counted.add_argument("target")
    counted.add_argument("split_bytes", type=int, nargs="?")
    counted.set_defaults(run=_word_count)

    sweep = jobs.add_parser("split-sweep", help="time the word count by split size")
    sweep.add_argument("source")
    sweep.set_defaults(run=lambda spark, o: word_count.split_sweep(spark, o.source).show())

    for name, run, text in (
        ("metadata", _metadata, "header metadata and its summaries"),
        ("similarity", _similarity, "books most similar to one book"),
        ("network", _network, "influence between authors"),
    ):
        job = jobs.add_parser(name, help=text)
        job.add_argument("source", help="folder of .txt files")
        job.add_argument("target", help="folder for the result files")
        job.add_argument(
            "--stop",
            action="store_true",
            help="stop at a file that cannot be read, where others go on and name it",
        )
        if name == "similarity":
            job.add_argument("--book", default=similarity.TARGET)
            job.add_argument("--exact", action="store_true", help="do not hash terms")
        if name == "network":
            job.add_argument("--edges", action="store_true", help="write every edge, quadratic")
        job.set_defaults(run=run)
    return parser


def _books(spark, options):
    if options.stop:
        return books(spark, options.source)
    return book_outcomes(spark, options.source).filter("error is null").drop("error")


def _name_unread(spark, options, seen) -> None:
    """By the listing and the names in a written table; nothing is read again."""
    if not options.stop:
        left = unread(file_listing(spark, options.source), seen)
        print("not read:")
        left.orderBy("file_name").show(truncate=False)


def _word_count(spark, options) -> None:
    spent = word_count.run(spark, options.source, options.target, options.split_bytes)
    print(f"{spent} ms")


def _metadata(spark, options) -> None:
    found = metadata.report(_books(spark, options))
    _name_unread(spark, options, found.metadata)
    found.counts().show()
    found.sample().show(truncate=False)
    found.per_year().show(truncate=False)
    found.per_language().show(10, truncate=False)
    found.average_title_length().show()
    found.title_statistics().show()
    found.save(options.target)


def _similarity(spark, options) -> None:
    compare = similarity.exact if options.exact else similarity.hashed
    found = compare(_books(spark, options), options.book)
    _name_unread(spark, options, found.books())
    found.counts().show()
    print(f"compared with {found.target}")
    found.top().show(truncate=False)
    found.save(options.target)


def _network(spark, options) -> None:
    found = influence.network(_books(spark, options))
    _name_unread(spark, options, found.fields)
    found.counts().show()
    found.sample().show(truncate=False)
    found.variants().show(10, truncate=False)
    for influential, influenced in found.top_of_windows().values():
        influential.show(truncate=False)
        influenced.show(truncate=False)
    found.sweep().show()
    found.save(options.target, edges=options.edges)


if __name__ == "__main__":
    main()
