"""Tables written to the cluster's shared folder, to cut lineage and to survive lost executors."""

from corpuskit.sources.shared import drop, dropping, materialise, new_path, read_back, write

__all__ = ["drop", "dropping", "materialise", "new_path", "read_back", "write"]
