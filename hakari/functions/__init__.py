"""Column functions: text, URLs, HTML, clock times, closing days, departments."""
