"""Files read by position or in pieces: by their own path, or through Arrow's stores."""


def local_path(path: str) -> str | None:
    """The path in the machine's own file system (a shared mount, on a cluster), if it is one."""
    if path.startswith("file:"):
        return "/" + path.removeprefix("file:").lstrip("/")
    return path if path.startswith("/") else None


def remote_store(path: str):
    """Arrow's module of file systems, the one of a URI, and the path in it."""
    from pyarrow import fs

    return fs, *fs.FileSystem.from_uri(path)


def opened(file: str):
    local = local_path(file)
    if local:
        return open(local, "rb")
    _, store, path = remote_store(file)
    return store.open_input_file(path)
