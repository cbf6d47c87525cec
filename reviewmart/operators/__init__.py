"""DataFrame operators of the review pipeline."""
