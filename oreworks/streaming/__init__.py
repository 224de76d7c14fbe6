"""Continuous runs over a folder: file streams into the layers."""
