"""Tables to read from and the lake to write to."""
