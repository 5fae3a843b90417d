"""streaming of quillstone."""
