"""Column-to-column rules shared by batch and streaming."""
