"""Reading landed feed files and writing the published series."""
