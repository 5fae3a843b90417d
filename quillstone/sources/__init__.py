"""sources of quillstone."""
