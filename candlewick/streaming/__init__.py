from .pickup import pick_up, refresh, track_newest, tracked_newest

__all__ = ["pick_up", "refresh", "track_newest", "tracked_newest"]
