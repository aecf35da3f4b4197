"""Relational operators over tracks, points, poses and logs."""
