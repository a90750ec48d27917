"""Tables written in the folder that all executors share, to cut lineage."""

from tessellum.storage import materialise, shared_folder

__all__ = ["materialise", "shared_folder"]
