"""Files below a folder, for code that has no Spark session: planning and tasks of the ``topicflow`` format.

Folders are plain paths, ``file:`` addresses, or whatever pyarrow can open by address (``hdfs://``, ``s3://``). The calls that
:class:`topicflow.storage.Store` has too behave alike.
"""

from __future__ import annotations

import contextlib
import os
import re
import uuid

from pyarrow import fs

from topicflow.errors import InvalidName


class MountedFiles:
    def __init__(self, root: str):
        self.root = root
        if root.startswith("file:"):
            self.system, self.base = fs.LocalFileSystem(), re.sub("^file:/+", "/", root)
        elif "://" in root:
            self.system, self.base = fs.FileSystem.from_uri(root)
        else:
            self.system, self.base = fs.LocalFileSystem(), root
        self.local = isinstance(self.system, fs.LocalFileSystem)

    def path(self, path: str) -> str:
        """The place of a file, given below ``root``, in this file system."""
        if not path.startswith(self.root):
            raise InvalidName(f"{path} is not below {self.root}")
        return self.base + path[len(self.root) :]

    def exists(self, path: str) -> bool:
        return self.system.get_file_info(self.path(path)).type != fs.FileType.NotFound

    def text_if_there(self, path: str) -> str | None:
        try:
            with self.system.open_input_file(self.path(path)) as file:
                return file.read().decode("utf-8")
        except FileNotFoundError:
            return None

    def _draft(self, path: str, text: str) -> tuple[str, str]:
        place = self.path(path)
        folder, _, name = place.rpartition("/")
        draft = f"{folder}/_{name}.{uuid.uuid4().hex}"
        self.system.create_dir(folder, recursive=True)
        with self.system.open_output_stream(draft) as file:
            file.write(text.encode("utf-8"))
        return draft, place

    def commit_text(self, path: str, text: str) -> bool:
        """Create a small file in one step; False when it exists."""
        if not self.local and not isinstance(self.system, fs.HadoopFileSystem):
            raise InvalidName(f"{self.root}: this store cannot create a file only if there is none")
        draft, place = self._draft(path, text)
        try:
            if self.local:
                os.link(draft, place)
            else:
                self.system.move(draft, place)  # fails onto an existing file
        except OSError:
            if self.exists(path):
                return False
            raise
        finally:
            if self.local:
                os.unlink(draft)
        return True

    def replace_text(self, path: str, text: str) -> None:
        """Write a small file in one step, over an older one if there is one."""
        draft, place = self._draft(path, text)
        if self.local:  # Hadoop's checksum of the older file, if that was written by Spark
            folder, _, name = place.rpartition("/")
            with contextlib.suppress(FileNotFoundError):
                os.unlink(f"{folder}/.{name}.crc")
        self.system.move(draft, place)

    def move_folder(self, source: str, target: str) -> None:
        self.system.create_dir(self.path(target).rpartition("/")[0], recursive=True)
        self.system.move(self.path(source), self.path(target))

    def drop(self, path: str) -> None:
        """Remove a folder that this library has just written."""
        if self.exists(path):
            self.system.delete_dir(self.path(path))
