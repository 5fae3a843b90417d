"""functions of quillstone."""
