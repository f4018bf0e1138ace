"""Jobs: read a layer, apply operators, write the next layer."""
