"""The stage graph and its runner."""
