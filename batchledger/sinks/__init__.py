"""Writers: accounting exports, XML records, id lists and edge lists."""
