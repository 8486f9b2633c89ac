"""Readers of landed files: delimited and free text, JSON, XML, HTML, archives, pages, grids."""
