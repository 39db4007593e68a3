"""What a user calls: dump to relations, relations to link statistics."""
