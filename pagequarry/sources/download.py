"""Fetching of dump files to a folder: anew only if the source has changed, with retries, unpacked on the way if asked."""

from __future__ import annotations

import bz2
import gzip
import os
import shutil
import time
import urllib.error
import urllib.request
from collections.abc import Callable
from email.utils import parsedate_to_datetime
from pathlib import Path

OPENERS = {".gz": gzip.open, ".bz2": bz2.open}
CHUNK = 1 << 20


def download(url: str, folder: str, *, tries: int = 3, pause: float = 1.0, unpack: bool = False, progress: Callable[[int], object] | None = None) -> Path:
    """The file that an address names, in a folder. A copy of the source's own time and size is kept as it is.

    A file is written beside its place and moved there when it is whole, so a broken fetch leaves none.
    progress: gets the number of bytes so far. Addresses may be of any scheme that urllib opens.
    """
    target = Path(folder) / url.rstrip("/").rpartition("/")[2]
    packed = target.suffix in OPENERS and unpack
    final = target.with_suffix("") if packed else target
    Path(folder).mkdir(parents=True, exist_ok=True)
    for attempt in range(1, tries + 1):
        part = target.with_name(target.name + ".part")
        try:
            with urllib.request.urlopen(url, timeout=60) as source:
                stamp = source.headers.get("Last-Modified")
                changed = parsedate_to_datetime(stamp).timestamp() if stamp else None
                if changed is not None and final.exists() and abs(final.stat().st_mtime - changed) < 1:
                    return final
                done = 0
                with part.open("wb") as out:
                    while data := source.read(CHUNK):
                        out.write(data)
                        done += len(data)
                        if progress:
                            progress(done)
                expected = source.headers.get("Content-Length")
                if expected and int(expected) != done:
                    raise urllib.error.ContentTooShortError(f"{done} of {expected} bytes", b"")
            if packed:
                with OPENERS[target.suffix](part, "rb") as source, final.open("wb") as out:
                    shutil.copyfileobj(source, out, CHUNK)
                part.unlink()
            else:
                part.replace(final)
            if changed is not None:
                os.utime(final, (changed, changed))
            return final
        except (OSError, EOFError):
            part.unlink(missing_ok=True)
            if attempt == tries:
                raise
            time.sleep(pause * attempt)
    raise AssertionError("tries must be positive")
