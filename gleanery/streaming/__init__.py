"""The stateless column operators applied to a stream."""
