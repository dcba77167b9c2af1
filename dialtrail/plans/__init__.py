"""The wide report, its snapshot, and publishing."""
