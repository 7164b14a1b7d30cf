import re

from corpusloom.__main__ import main


def parts(folder):
    return "".join(p.read_text() for p in sorted(folder.glob("part-*")))


def test_jobs_over_a_folder_of_books(spark, tmp_path, capsys):
    corpus = tmp_path / "corpus"
    corpus.mkdir()
    for i in range(8):
        (corpus / f"{i}.txt").write_text(
            f"Title: Book {i}\nAuthor: Writer {i % 3}\nRelease Date: May {1900 + 3 * i}\n"
            f"Language: English\n*** START OF IT\nwhale ship {'sea ' * i}\n*** END OF IT\n"
        )
    (corpus / "folder.txt").mkdir()
    (corpus / "_hidden.txt").write_text("Title: Hidden\n")
    main(["word-count", str(corpus), str(tmp_path / "words"), "1000"])
    assert "whale\t8\n" in parts(tmp_path / "words")
    main(["split-sweep", str(corpus)])
    main(["metadata", str(corpus), str(tmp_path / "meta")])
    assert "_hidden.txt,Hidden," in parts(tmp_path / "meta")
    assert "0.txt,Book 0,May 1900,English," in parts(tmp_path / "meta")
    for more in ([], ["--exact"]):
        main(["similarity", str(corpus), str(tmp_path / "similar"), "--book", "3.txt", *more])
        assert parts(tmp_path / "similar").startswith("Top 5 books similar to 3.txt:\n")
    main(["network", str(corpus), str(tmp_path / "net"), "--edges"])
    assert parts(tmp_path / "net" / "edges").count("\n") > 0
    shown = capsys.readouterr().out
    assert " ms\n" in shown
    assert shown.count("|folder.txt|") == 4
    assert re.search(r"\| *books\| *9\|", shown) and re.search(r"\| *author books\| *8\|", shown)
    assert "book_count" in shown and "window_years" in shown
