"""Archive members are read again through a new handle when the old one fails."""

from __future__ import annotations

import zipfile

import pytest
from pyarrow import fs

from editloom.llm import media


class Failing:
    """A file system whose handles fail after a number of reads; the handles that it has opened are counted."""

    def __init__(self, reads, openings=0):
        self.reads, self.openings, self.opened, self.real = reads, openings, 0, fs.LocalFileSystem()

    def open_input_file(self, path):
        self.opened += 1
        if self.opened <= self.openings:
            raise OSError("cannot be opened now")
        return FailingFile(self.real.open_input_file(path), self)


class FailingFile:
    def __init__(self, file, owner):
        self.file, self.left = file, owner.reads

    def read_at(self, *a):
        self.left -= 1
        if self.left < 0:
            raise OSError("connection reset")
        return self.file.read_at(*a)

    def close(self):
        self.file.close()


@pytest.fixture
def archive(tmp_path, monkeypatch):
    monkeypatch.setattr(media.time, "sleep", lambda s: None)
    with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_DEFLATED) as z:
        for i in range(6):
            z.writestr(f"{i}-0-0.wav", media.to_wave(b"x" * 100 + bytes([i])))
    return tmp_path / "a.zip", zipfile.ZipFile(tmp_path / "a.zip").infolist()


def read(archive, files, tries=3):
    path, members = archive
    reader, handle = media.ArchiveReader({"path": str(path.parent), "tries": str(tries)}), media._Handle(files, str(path))
    return [reader._member(handle, m) for m in members]


def test_a_broken_handle_is_opened_anew(archive):
    files = Failing(reads=5)  # two reads a member: every third member meets a handle that fails
    found = read(archive, files)
    assert all(error is None and data for data, error in found) and files.opened == 3


def test_what_always_fails_keeps_its_row(archive):
    files = Failing(reads=0)
    found = read(archive, files)
    assert all(data is None and "connection reset" in error for data, error in found) and files.opened == 18
    assert [e for _, e in read(archive, Failing(reads=100, openings=2))] == [None] * 6
    assert read(archive, Failing(reads=100, openings=5), tries=1)[0][1].startswith("OSError")
