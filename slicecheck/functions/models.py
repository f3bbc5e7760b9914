"""Model ids with a meaning of their own."""

from __future__ import annotations

# The ids of the logical models.
LOGICAL_MODEL_IDS = [
    "8754c12317614fc483041aaf2ed204a4",
    "c8c626d448b249839a4d8d99df3a07dc",
    "ca00314cf3b54e5eb155ab187d886115",
    "8ba6bb5de6354509ac51ba5118827b73",
    "fc4e765c400b4c47a50388d3fa719c87",
    "751449dfac9e4b389f87fec3a0288635",
    "61237fb7cee64838a6851889457ccd2b",
    "a63282dc234b4e2dba95b0d1a5ca0a0a",
    "915b9b5c2e5a4716a62d809589c1de67",
    "40ddb8569f514fdd9688d75e3641bc4b",
    "03d19f3f67c346da8a1c0642eb492a16",
    "c8d9977283b64ceda80c7bd653c4bfca",
    "adc4c172b6ca4d95887738fd619e8370",
    "be38d5185e78414aa72b76b246edfbaa",
    "48102c08383143c19c43b6577bacda31",
    "06c83c836ee54c559e551e284efecf09",
    "6df0306b30d8432bb1ec2e3fc182478d",
    "098e5262a8754e7e95d062c78c4dff56",
    "921e37d62c264e98925900794dbf3e1a",
    "ed66ec3be62b4f66b70144f002b1c8ad",
    "674f6d795ad64b1485269189922ec0f0",
    "24d3c81e23a44cd5b88b19c12db0a88d",
    "bb19feb21c5a44bd9b6a16435decc563",
    "8a130ad3d1e34072b98eb6d0d590cc84",
    "b99ae9282d6442459ef352941ccd0114",
    "c498ba5f8176411a995f46ae5d3fc03e",
    "aa7147f72e4d4d7db9c57f463fde12cf",
    "2ac995eb3b3c43eaa92106588c23933f",
    "a20e6469ad7149bbaed704065621a475",
    "b88715118cd346dc9367f7137d9c7362",
    "c79ea7bf93a341e4b4ade4dd2a639aba",
    "852456ca54f0453f9c52c00053b8566c",
    "0c537b35413e42b6aa13b5bfea06b887",
    "cce4f6fb9452440d83f08260a550ac58",
    "2b75b22370e547e6a13055d70b7636e8",
    "e9256d1c70744efa9b8b81f7d7613842",
    "e3b9e8dd75c4476da235dfac7bd21455",
    "a91b93f80e694ea8b3549d756eace40c",
    "106dc9feea5a4293b9faac8f1c59a5b4",
    "44ef145e87f74b85bbb82ef4a0124db7",
    "15e575caa63840e6971bd54e194e9415",
    "554c06df77024dc49070b00d97a8a52c",
    "0e3fde18a30c44d5800595b93a5920a0",
    "a33e45de710b48d898e621f57425555e",
    "811d07eec78e4902bb81de15e82688ad",
    "1e0802f98aff43d797a0ab9f784c883b",
    "4cc590e0edfd4a0190d2aa8bbf0a2dce",
    "150e760fc7b0498ca13e94da5b228280",
    "87657b36aaaf42e8bc9b583d4fd6ba2a",
    "b13dd639ff564f9591a7e241438fc6df",
    "66b48cc6e42a4275a30e02229506a9a0",
    "92d3fba41f2345dbbf354f70ff8a7bb2",
    "f7f46a45325a42d3b0053264b9c9b33f",
    "54627f100a6842dcb653870ab491a0e7",
    "75ec18db81444aa2950158bfbff1d216",
    "50576e4e541c4d3db6f4bb6431319761",
    "3a3911577f4a4594860195576b4e4101",
    "951ad22ad6204de49e58d8d5bc8afd63",
    "fef5dfaa3f8645cfa390bbc8427c298d",
    "7a43e75e327741a48a31ce4b513995d4",
    "b5c6cd05cfa940f5b619ef912588221b",
    "853a44dc55224dea9c07d890bd377c99",
    "3217efdf41624113a68cc01fabc66f30",
    "d229409c296141469b118cf297737d13",
    "17af96f2f637447b8f8b6801af21b314",
    "a6f83037ed704f7cacec80b7bb1371ad",
    "2e533e4d2095445cb03aae74783de8d3",
    "c1a5d49456cf48749cf128803a811286",
    "cc2de341d0b94ce9b668406ce21cc11d",
    "fa3eb9daa36f4d11bcf362429edd91e5",
    "b2c30197822847e79ee10fe16ba9782d",
    "9a267d18d85e4fe8bdfc5967f79f20ba",
    "e54732ff8e984ed582db3716763e9082",
    "6de9660fa47f452d831b1401d8840de3",
    "6497f8458bb440b09e71ba30c9dea8bb",
    "37f40ca672424c47b0e6d83cb2f75ce6",
    "db85a4fbab044f68988e791314f447e8",
    "bc9f978d5292480ab7d2279ad172a7bf",
    "a485cfe4f9034efb8e6c230ba7d0e1e1",
    "e18613e69e184cd9aaa393e7c16d1a93",
    "80bd65b06efc4212b3726a2c90011faa",
    "94f8ee80ff7641e99fd4dc8cfe2ed0b4",
    "d3d34a044a7d4299b07e9e84c16c242b",
    "a4d8813676b048e195e71abb9506c340",
    "9c4d7102e81846e496c0a74b33ae1bae",
    "32aaa24f4ea64344a3ccd753562c10c0",
    "34f1106c4a5b41f491cd5a89a24d40fa",
    "829691160b5240f0a2a3492fabafdb55",
    "53e1a728f22849f082cbbb6b2d52a82f",
    "409d55ac4fc04422ba40e5d79e4963a1",
    "4312dc43d8524913b18a94be7f33a64b",
    "5b8af4444b564668bbccf8ad59d1efc7",
    "23c338e6fb0c480c8ac16a6f4cba3d69",
    "e590359d08c546929e8892bee89158d4",
    "f226a0f924ef444fb4539a1a0f65ebe1",
    "41fa41a4999e44c891b0773ad88064ee",
    "9fd5132c257c44719a010d06c38e34fc",
    "e6c6001975474f6b8dc108c846545ac7",
    "439a1adb51b74a42ab2f62cc2a51cd7e",
    "3a3009805b5c429fb2eec46dbb76af68",
    "60b399fd8c1743a49fa52cb49a76cc79",
    "9540f59255fd4baaa633aeafac94c846",
    "0f6c7ff852194fb8be4c2a87608b390f",
    "f1299a1a19aa4898be45e223030d80bd",
    "ceb5ad908f93433a97dc2ef10ab01fe8",
]
