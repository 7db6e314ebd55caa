"""Writers: landing files, staged frames, catalog tables."""
