"""Where records come from: named collections and the landed table."""

from plumbline.sources.collection import Collection, Load, load_collection, since
from plumbline.sources.landed import day_mark, high_water_mark, read_landed

__all__ = ["Collection", "Load", "day_mark", "high_water_mark", "load_collection", "read_landed", "since"]
