"""Licences as data: fixed values, from public texts and identifiers.  A list of another size and source does as well."""

from __future__ import annotations

#: Phrases whose every place counts by itself: fixed values of the base columns, phrase -> label.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Texts and notices: (label, text, its mandatory key phrase).
TEMPLATES: tuple[tuple[str, str, str], ...] = (
    ("apache", "licensed under the apache license version 2 0", "apache license"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license", "specific language governing permissions and limitations"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", "released under the mit licence", "mit licence"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "hereby granted free of charge"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution", "redistribution and use in source and binary forms"),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", "endorse or promote products derived from this software"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", "distribute this software for any purpose"),
    ("zlib", "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions the origin of this software must not be misrepresented you must not claim that you wrote the original software", "origin of this software must not be misrepresented"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("lgpl", "under the terms of the gnu lesser general public license", "lesser general public license"),
    ("agpl", "under the terms of the gnu affero general public license", "affero general public license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version", "redistribute it and or modify it under the terms"),
    ("gpl-2", "gnu general public license version 2", "general public license version 2"),
    ("gpl-3", "gnu general public license version 3", "general public license version 3"),
    ("epl", "made available under the terms of the eclipse public license v 2 0", "eclipse public license"),
    ("eupl", "licensed under the european union public licence", "european union public licence"),
    ("cddl", "subject to the terms of the common development and distribution license", "common development and distribution license"),
    ("bsl", "distributed under the boost software license version 1 0", "boost software license"),
    ("wtfpl", "do what the fuck you want to public license", "what the fuck you want to"),
    ("artistic", "the artistic license 2 0", "artistic license"),
    ("ofl", "this font software is licensed under the sil open font license version 1 1", "open font license"),
    ("public-domain", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means", "released into the public domain"),
    ("cc0", "to the extent possible under law dedicated to the public domain cc0 1 0 universal", "cc0 1 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc-by-nd", "licensed under cc by nd 4 0", "cc by nd"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", "creative commons attribution"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license", "creative commons attribution sharealike"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license", "creative commons attribution noncommercial"),
    ("spdx", "spdx license identifier", "spdx license identifier"),
    ("warranty", "provided as is without warranty of any kind express or implied", "without warranty of any kind"),
)

#: Identifiers and names that stand by themselves: phrase -> label.
NAMES = {
    "apache 2 0": "apache", "asl 2 0": "apache", "bsd 2 clause": "bsd", "bsd 3 clause": "bsd", "bsd license": "bsd", "bsd licence": "bsd", "isc license": "isc", "zlib license": "zlib",
    "mpl 1 1": "mpl", "mpl 2 0": "mpl", "gpl 2 0": "gpl-2", "gpl 2 0 only": "gpl-2", "gpl 2 0 or later": "gpl-2", "gplv2": "gpl-2", "gnu gpl v2": "gpl-2", "gpl 3 0": "gpl-3", "gpl 3 0 only": "gpl-3", "gpl 3 0 or later": "gpl-3", "gplv3": "gpl-3", "gnu gpl v3": "gpl-3",
    "lgpl 2 1": "lgpl", "lgpl 3 0": "lgpl", "lgplv2": "lgpl", "lgplv2 1": "lgpl", "lgplv3": "lgpl", "agpl 3 0": "agpl", "agplv3": "agpl", "epl 1 0": "epl", "epl 2 0": "epl", "eupl": "eupl", "cddl 1 0": "cddl", "bsl 1 0": "bsl", "artistic 2 0": "artistic", "ofl 1 1": "ofl", "unlicense": "public-domain", "wtfpl": "wtfpl", "cc0": "cc0",
}
