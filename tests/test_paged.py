"""Pages of a stored bucket, read by their tokens."""

from __future__ import annotations

import json

from converge.sources import paged


class Counted:
    """A file system or a file that counts the bytes that are read from it."""

    def __init__(self, inner, seen):
        self.inner, self.seen = inner, seen

    def __getattr__(self, name):
        return getattr(self.inner, name)

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.inner.close()

    def open_input_stream(self, path):
        return Counted(self.inner.open_input_stream(path), self.seen)

    def open_input_file(self, path):
        return Counted(self.inner.open_input_file(path), self.seen)

    def read(self, *n):
        found = self.inner.read(*n)
        self.seen.append(len(found))
        return found


def test_a_page_reads_no_more_than_itself(tmp_path, monkeypatch):
    (tmp_path / "bucket=b").mkdir()
    wanted = [{"k": k, "t": "é \x85" + "x" * (k % 7 * 300)} for k in range(3000)]
    for n, rows in enumerate((wanted[:2000], [], wanted[2000:])):
        (tmp_path / "bucket=b" / f"part-{n}").write_text("".join(json.dumps(r, ensure_ascii=False) + "\n" for r in rows), newline="")
    files, seen = paged.FolderStore._files, []
    monkeypatch.setattr(paged.FolderStore, "_files", lambda self: (lambda fs, root: (Counted(fs, seen), root))(*files(self)))
    store, token, got = paged.FolderStore(str(tmp_path)), None, []
    while True:
        rows, token = store.page("b", token, 10)
        got += rows
        if token is None:
            break
        assert len(rows) == 10
    assert got == wanted
    assert sum(seen) < 5 * sum(f.stat().st_size for f in tmp_path.glob("*/part-*"))
    assert store.page("none", None, 10) == ([], None)
