"""Sources: raw responses, location dimension, request manifest, lake and state scans."""
