"""Opening one file from a task, on whatever file system its URI names."""

from __future__ import annotations

from urllib.parse import unquote


def file_system(path: str):
    """(file system, place on it) of a local path or a URI."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), unquote("/" + path[len("file:"):].lstrip("/"))
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def list_files(folder: str) -> list[tuple[str, int]]:
    """(path below the folder, bytes) of every file under it, in order of path; none if there is no folder."""
    from pyarrow import fs

    system, where = file_system(folder)
    found = system.get_file_info(fs.FileSelector(where, recursive=True, allow_not_found=True))
    start = len(where.rstrip("/")) + 1
    return sorted((f.path[start:], f.size) for f in found if f.is_file)


def open_stream(path: str, seekable: bool = False, write: bool = False):
    """A binary stream for a local path or a URI; readers decompress by suffix unless ``seekable``."""
    system, where = file_system(path)
    if write:
        system.create_dir(where.rsplit("/", 1)[0], recursive=True)
        return system.open_output_stream(where, compression=None)
    return system.open_input_file(where) if seekable else system.open_input_stream(where)


def xml_events(file, whole: str | None = None):
    """(event, element, open ancestors) of an XML stream in constant memory.

    An element is let go when it ends, unless it lies within an element with the tag ``whole``.
    """
    import xml.etree.ElementTree as ET

    above: list = []
    inside = 0
    for event, node in ET.iterparse(file, events=("start", "end")):
        if event == "start":
            yield event, node, above
            above.append(node)
            inside += node.tag == whole
            continue
        above.pop()
        inside -= node.tag == whole
        yield event, node, above
        if not inside and above:
            above[-1].remove(node)


def tag_statistics(file) -> dict[str, tuple[int, int]]:
    """How often each tag of an XML stream opens and how deep at most (the root is 1), in the order of first occurrence."""
    seen: dict[str, tuple[int, int]] = {}
    for event, node, above in xml_events(file):
        if event == "start":
            n, depth = seen.get(node.tag, (0, 0))
            seen[node.tag] = n + 1, max(depth, len(above) + 1)
    return seen
