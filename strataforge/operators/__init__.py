"""Operators over the layers as DataFrame plans."""
