"""Sources: landed repository trees and landed wiki responses."""
