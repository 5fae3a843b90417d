"""operators of quillstone."""
