"""Direct access to files on the file systems Arrow knows: local, HDFS and object stores."""

from __future__ import annotations

import re
import warnings

from quayside.session import sent_with_jobs

sent_with_jobs(__name__)


def file_system(path: str):
    """(file system, path on it) of a path as Spark writes it: /x, file:/x, hdfs://..., s3a://..."""
    from pyarrow import fs

    if "://" not in path:
        path = "file://" + path.removeprefix("file:")
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", path))


def open_seekable(path: str):
    system, inner = file_system(path)
    return system.open_input_file(inner)


def write_bytes(path: str, data: bytes) -> None:
    system, inner = file_system(path)
    system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(inner, compression=None) as out:
        out.write(data)


def remove_folder(path: str) -> None:
    """Delete a scratch folder made by `new_folder`; what cannot be deleted stays, with a warning."""
    if "/quayside/" not in path:
        raise ValueError(f"not a scratch folder: {path}")
    try:
        system, inner = file_system(path)
        system.delete_dir(inner)
    except Exception as e:  # the work it served is done and committed
        warnings.warn(f"scratch folder {path} not removed: {e}")


def open_output(path: str):
    """A new file to be written from front to back; its folder is made."""
    system, inner = file_system(path)
    system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(inner, compression=None)
