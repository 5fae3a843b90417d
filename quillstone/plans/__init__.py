"""plans of quillstone."""
