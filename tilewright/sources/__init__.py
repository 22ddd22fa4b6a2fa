"""Tables, images, split archives and stores."""
